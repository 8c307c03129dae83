"""Text functions: chunking, markup, list literals, templates, masking."""

from __future__ import annotations

import html as _html
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_PLAIN = pa.string()


def chunk_fixed(text: Column, size: int, overlap: int = 0) -> Column:
    """Chunks of ``size`` characters, each beginning ``size - overlap`` after the one before.

    Null gives null, an empty text no chunk. A last chunk that lay wholly in the one before is left out.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")
    step = size - overlap
    n = F.char_length(text)
    last = F.floor(F.greatest(n - overlap - 1, F.lit(0)) / step)
    starts = F.sequence(F.lit(0).cast("long"), last)
    return F.when(n > 0, F.transform(starts, lambda k: F.substring(text, (k * step + 1).cast("int"), F.lit(size)))).when(n == 0, F.array().cast("array<string>"))


#: Where the recursive splitter prefers to cut, coarsest first.
SEPARATORS = ("\n\n", "\n", ". ", " ", "")


def _split(text: str, size: int, overlap: int, separators) -> list[str]:
    if len(text) <= size:
        return [text] if text else []
    separator, rest = separators[0], separators[1:]
    if not separator:
        step = size - overlap
        return [text[k : k + size] for k in range(0, max(1, len(text) - overlap), step)]
    chunks, current = [], ""
    for part in re.split(f"(?<={re.escape(separator)})", text):
        if len(part) > size:
            if current:
                chunks.append(current)
                current = ""
            chunks += _split(part, size, overlap, rest)
        elif len(current) + len(part) > size:
            chunks.append(current)
            current = (current[-overlap:] if overlap and overlap + len(part) <= size else "") + part
        else:
            current += part
    return chunks + ([current] if current else [])


def chunk_recursive(text: Column, size: int, overlap: int = 0) -> Column:
    """Chunks of at most ``size`` characters, cut at paragraphs, else lines, sentences, words, characters."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else _split(t, size, overlap, SEPARATORS) for t in texts.to_pylist()], pa.list_(_PLAIN))

    return F.arrow_udf(run, "array<string>")(text)


def chunk_words(text: Column, size: int, overlap: int = 0) -> Column:
    """Chunks of ``size`` white-space-separated words, joined by single spaces; all JVM-side."""
    step = size - overlap
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    last = F.floor(F.greatest(F.size(words) - overlap - 1, F.lit(0)) / step)
    return F.when(
        F.size(words) > 0,
        F.transform(F.sequence(F.lit(0).cast("long"), last), lambda k: F.array_join(F.slice(words, (k * step + 1).cast("int"), F.lit(size)), " ")),
    ).when(text.isNotNull(), F.array().cast("array<string>"))


#: What counts as a token where no vocabulary is given: words, numbers, single marks.
TOKEN = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]"


def chunk_tokens(text: Column, size: int, overlap: int = 0, token: str = TOKEN) -> Column:
    """Chunks of ``size`` tokens, each beginning ``size - overlap`` after the one before; the text between tokens is kept.

    White space belongs to the token that follows it; what follows the last token is left out. Null gives null, a text
    without tokens no chunk. All JVM-side; ``token`` is any pattern, such as that of a public tokenizer's words.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")
    step = size - overlap
    pieces = F.regexp_extract_all(text, F.lit(rf"\s*(?:{token})"), F.lit(0))
    last = F.floor(F.greatest(F.size(pieces) - overlap - 1, F.lit(0)) / step)
    chunks = F.transform(F.sequence(F.lit(0).cast("long"), last), lambda k: F.array_join(F.slice(pieces, (k * step + 1).cast("int"), F.lit(size)), ""))
    return F.when(F.size(pieces) > 0, chunks).when(text.isNotNull(), F.array().cast("array<string>"))


class _Page(HTMLParser):
    _HIDDEN = {"script", "style", "template", "noscript"}
    _BREAKS = {"p", "div", "br", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "table", "ul", "ol"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title, self.links, self.text, self.hidden, self.in_title = "", [], [], 0, False

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in self._HIDDEN
        self.in_title |= tag == "title"
        if tag in self._BREAKS:
            self.text.append("\n")
        if tag == "a" and (href := dict(attrs).get("href")):
            self.links.append(href)

    def handle_endtag(self, tag):
        self.hidden -= tag in self._HIDDEN and self.hidden > 0
        if tag == "title":
            self.in_title = False
        if tag in self._BREAKS:
            self.text.append("\n")

    def handle_data(self, data):
        if self.in_title:
            self.title += data
        elif not self.hidden:
            self.text.append(data)


def html_extract(page: Column) -> Column:
    """``struct(title, text, links)`` of an HTML page, however broken; null gives null."""

    def run(pages: pa.Array) -> pa.Array:
        rows = []
        for p in pages.to_pylist():
            if p is None:
                rows.append(None)
                continue
            parser = _Page()
            parser.feed(p)
            parser.close()
            lines = (re.sub(r"\s+", " ", x).strip() for x in "".join(parser.text).split("\n"))
            rows.append({"title": parser.title.strip(), "text": "\n".join(x for x in lines if x), "links": parser.links})
        return pa.array(rows, pa.struct([("title", _PLAIN), ("text", _PLAIN), ("links", pa.list_(_PLAIN))]))

    return F.arrow_udf(run, "struct<title:string,text:string,links:array<string>>")(page)


def markdown_to_html(text: Column) -> Column:
    """The common block and inline marks of Markdown as HTML."""

    def inline(s):
        s = _html.escape(s, quote=False)
        s = re.sub(r"`([^`]+)`", r"<code>\1</code>", s)
        s = re.sub(r"\[([^\]]+)\]\(([^)\s]+)\)", r'<a href="\2">\1</a>', s)
        s = re.sub(r"\*\*([^*]+)\*\*", r"<strong>\1</strong>", s)
        return re.sub(r"(?<!\*)\*([^*\s][^*]*)\*(?!\*)", r"<em>\1</em>", s)

    def one(t):
        out, lines, k = [], t.splitlines(), 0
        while k < len(lines):
            line = lines[k]
            if m := re.match(r"```\s*\w*\s*$", line):
                end = next((j for j in range(k + 1, len(lines)) if lines[j].strip() == "```"), len(lines))
                out.append("<pre><code>" + _html.escape("\n".join(lines[k + 1 : end]), quote=False) + "</code></pre>")
                k = end + 1
                continue
            if m := re.match(r"(#{1,6})\s+(.*)", line):
                out.append(f"<h{len(m[1])}>{inline(m[2].strip())}</h{len(m[1])}>")
            elif re.match(r"[-*+]\s+", line):
                items = []
                while k < len(lines) and (m := re.match(r"[-*+]\s+(.*)", lines[k])):
                    items.append(f"<li>{inline(m[1])}</li>")
                    k += 1
                out.append("<ul>" + "".join(items) + "</ul>")
                continue
            elif line.strip():
                words = [line.strip()]
                while k + 1 < len(lines) and lines[k + 1].strip() and not re.match(r"#{1,6}\s|[-*+]\s|```", lines[k + 1]):
                    k += 1
                    words.append(lines[k].strip())
                out.append("<p>" + inline(" ".join(words)) + "</p>")
            k += 1
        return "\n".join(out)

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else one(t) for t in texts.to_pylist()], _PLAIN)

    return F.arrow_udf(run, "string")(text)


def html_to_markdown(page: Column) -> Column:
    """Headings, emphasis, code, links and list items of HTML as Markdown; all JVM-side."""
    out = page
    for level in range(1, 7):
        out = F.regexp_replace(out, rf"(?is)<h{level}[^>]*>(.*?)</h{level}>", "\n" + "#" * level + " $1\n")
    for pattern, mark in (
        (r"(?is)<(?:strong|b)\b[^>]*>(.*?)</(?:strong|b)>", "**$1**"),
        (r"(?is)<(?:em|i)\b[^>]*>(.*?)</(?:em|i)>", "*$1*"),
        (r"(?is)<code\b[^>]*>(.*?)</code>", "`$1`"),
        (r'(?is)<a\b[^>]*href="([^"]*)"[^>]*>(.*?)</a>', "[$2]($1)"),
        (r"(?is)<li\b[^>]*>(.*?)</li>", "- $1\n"),
        (r"(?i)<br\s*/?>|</p>", "\n"),
        (r"<[^>]+>", ""),
        (r"\n{3,}", "\n\n"),
    ):
        out = F.regexp_replace(out, pattern, mark)
    return F.trim(out)


def parse_list_literal(text: Column) -> Column:
    """``['GET', 'PUT']`` or plain ``POST`` as an array; null gives null."""
    listed = F.from_json(F.translate(text, "'", '"'), "array<string>")
    return F.when(F.ltrim(text).startswith("["), listed).when(text.isNotNull(), F.array(text))


def split_comma_list(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


def filename_parts(filename: Column) -> Column:
    """``N_Service[_Service]_Action_Kind[.json]`` as a struct, N of 1 to 18 digits; parts that are not there are null."""
    stem = F.regexp_replace(filename, r"\.json$", "")
    parts = F.split(stem, "_")
    numbered = F.element_at(parts, 1).rlike(r"^\d{1,18}$")
    rest = F.when(numbered, F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))).otherwise(parts)
    n = F.size(rest)
    return F.struct(
        F.when(numbered, F.element_at(parts, 1).cast("long")).alias("number"),
        F.when(n >= 2, F.array_join(F.slice(rest, F.lit(1), F.greatest(n - 2, F.lit(0))), "_")).alias("services"),
        F.when(n >= 2, F.try_element_at(rest, n - 1)).alias("action"),
        F.when(n >= 1, F.try_element_at(rest, n)).alias("kind"),
    )


def join_with_and(items: Column) -> Column:
    """``a``, ``a and b``, ``a, b, and c``; at most the first three."""
    n = F.size(items)
    at = lambda k: F.get(items, F.lit(k))
    three = F.concat(at(0), F.lit(", "), at(1), F.lit(", and "), at(2))
    return F.when(n == 1, at(0)).when(n == 2, F.concat(at(0), F.lit(" and "), at(1))).when(n >= 3, three)


def describe(prefix: Column, services: Column, purpose: Column, nodes: Column) -> Column:
    """One sentence on a workflow and one on its size, in the catalog's wording."""
    n = F.size(services)
    verb = F.when(n == 1, "integrates with ").when(n == 2, "connects ").when(n >= 3, "orchestrates ")
    extra = F.when(n > 3, F.concat(F.lit(" and integrates with "), n, F.lit(" services"))).otherwise("")
    subject = F.coalesce(F.concat(F.lit(" that "), verb, join_with_and(services), F.lit(" "), purpose), F.lit(""))
    return F.concat(prefix, subject, F.lit(". Uses "), nodes, F.lit(" nodes"), extra, F.lit("."))


#: Kinds of sensitive text and what masks each; own patterns.
MASKS = (
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "<email>"),
    (r"\b(?:\d[ -]?){13,19}\b", "<number>"),
    (r"(?i)(bearer\s+)[A-Za-z0-9._~+/-]+=*", "$1<token>"),
    (r"\b\d{1,3}(?:\.\d{1,3}){3}\b", "<ip>"),
)


def mask_sensitive(text: Column) -> Column:
    for pattern, mark in MASKS:
        text = F.regexp_replace(text, pattern, mark)
    return text


def url_parts(url: Column) -> Column:
    """``struct(protocol, host, path, query)``; null where the text is no URL."""
    part = lambda p: F.try_parse_url(url, F.lit(p)).alias(p.lower())
    return F.struct(*map(part, ("PROTOCOL", "HOST", "PATH", "QUERY")))


def replace_credentials(parameters: Column, fields: list[str]) -> Column:
    """The values of the named parameters replaced by a reference of the same name."""
    return F.transform_values(
        parameters, lambda k, v: F.when(k.isin(fields), F.concat(F.lit("{{ $credentials."), k, F.lit(" }}"))).otherwise(v)
    )


def replace_urls(parameters: Column, variables: dict[str, str]) -> Column:
    """Values that begin with a known address begin with a reference to its environment variable instead; the longest address counts."""
    def one(value):
        out = value
        for address, name in sorted(variables.items(), key=lambda x: len(x[0])):
            rest = F.substring(value, F.lit(len(address) + 1), F.length(value))
            out = F.when(value.startswith(address), F.concat(F.lit("{{ $env." + name + " }}"), rest)).otherwise(out)
        return out

    return F.transform_values(parameters, lambda k, v: one(v))


def xml_to_json(text: Column, schema: str) -> Column:
    return F.to_json(F.from_xml(text, schema))


def json_to_xml(text: Column, schema: str, row_tag: str = "row") -> Column:
    return F.to_xml(F.from_json(text, schema), {"rowTag": row_tag})


def brand_match(text: Column, brand: str, never: list[str] | None = None) -> Column:
    """Whether a brand's name occurs, though not as the beginning of one of ``never``."""
    ahead = "".join(f"(?!{re.escape(n)})" for n in never or [])
    return text.rlike(f"(?i){ahead}{re.escape(brand)}")


def parse_items(text: Column) -> Column:
    """The non-empty lines of a text, without list marks."""
    lines = F.transform(F.split(text, r"\r?\n"), lambda x: F.trim(F.regexp_replace(x, r"^\s*(?:[-*•]|\d+[.)])\s+", "")))
    return F.filter(lines, lambda x: x != "")
