"""Secrets in source code and settings: found by one automaton, redacted in place.

Token formats, key armor, connection strings and ``label = value`` grammars are compiled into
one deterministic automaton. It runs over the parameters' bytes, laid end to end as
``=name=value`` so that a parameter's own name can be the label, in overlapping chunks, and gives
the absolute places where a value of each grammar begins; how far it goes is told by the bytes that
the grammar allows in it. Spans are de-duplicated, checked (which leaves out placeholders,
references, masked values and prose) and merged where they overlap; redaction splices a placeholder
of fixed form over each and touches nothing else.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .automaton import Automaton

LABELS = (
    "password", "passwd", "passphrase", "passwort", "pass", "pwd", "pw", "secret", "token", "api[_-]?key", "secret[_-]?key",
    "access[_-]?key", "private[_-]?key", "client[_-]?secret", "auth", "authorization", "credential", "signature", "sig", "key",
)

#: Labels in the corpus's other languages. Chinese ones stand amid other characters, the others begin a word.
LABELS_ZH = ("密码", "密碼", "口令", "密钥", "密鑰", "令牌")
LABELS_ABROAD = ("contrase(ñ|Ñ|ñ|n)a", "clave", "secreto", "kennwort", "schl(ü|Ü|ü|ue)ssel")
#: What opens a user and a password in prose: ``The login for a is b / c``.
LOGINS = ("log-?in", "log-?on", "sign-?in", "credential", "creds", "zugangsdaten", "anmeldedaten", "credencial", "acceso", "登录", "登錄", "登入", "账号", "帐号", "賬號")

_LABEL = "(" + "|".join(LABELS) + ")"
_ZH, _ABROAD, _LOGIN = ("(" + "|".join(x) + ")" for x in (LABELS_ZH, LABELS_ABROAD, LOGINS))


def _bytes(pattern: str) -> str:
    """A pattern over the bytes of UTF-8, as the automaton reads them."""
    return pattern.encode().decode("latin-1")


#: What the automaton looks for. Most patterns end with the first byte of a value.
PATTERNS = {
    "format": r"_(live|prod|srv|test|dev)_[a-z0-9]|eyj[a-z0-9_-]|gh[pousr]_|akia[a-z0-9]|xox[abprs]-|aiza[a-z0-9_-]|sk-[a-z0-9_-]",
    "armor": r"-----begin [a-z0-9 ]+-----",
    "connection": r"[a-z0-9+.-]://[^\s/@:\"'<>]*:[^\s/@\"'<>]",
    "labelled": _LABEL + r"\\?[\"'`]?\s*[:=]\s*\\?[\"'`]?[^\s\"'`]",
    "scheme": r"(bearer|basic)\s+[a-z0-9+/_.=-]",
    "account": r"[\s=](-u|--user)\s+[\"']?[^\s:\"']+:[^\s\"']",
    "literal": r"[=:]\s*[\"'`][a-z0-9+/_.-]",
    "abroad": _bytes(rf"({_ZH}[\"'`]?\s*(:|=|：|＝|是|为|為)|{_ABROAD}[\"'`]?\s*(:|=|：|＝)|{_LABEL}[\"'`]?\s*(：|＝))"),
    "login": _bytes(_LOGIN),
    "slash": _bytes(r"(\s(is|are|ist|sind|lautet|lauten|es|son)|:|：|是|为|為)(:|：)?\s*[\"'`]?[^\s/:\"'`]+[\"'`]?\s*/\s*[\"'`]?[^\s\"'`/]"),
}
_BIT = {name: 1 << k for k, name in enumerate(PATTERNS)}


def _table(characters: bytes, allowed: bool = False) -> np.ndarray:
    """Whether each byte ends a value of a grammar that forbids (or only allows) the given ones; the separator always does."""
    out = np.full(256, allowed)
    out[list(characters)] = not allowed
    out[0xFF] = True
    return out


_BLANKS = b" \t\n\r\x0b\x0c"
_ALNUM = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
#: What ends a value of each grammar.
_STOPS = {
    "format": _table(_ALNUM + b"_.-", True),
    "connection": _table(_BLANKS + b"/@\"'<>"),
    "raw": _table(_BLANKS + b"\"'`,;&(){}[]"),
    "scheme": _table(_ALNUM + b"+/_.=-", True),
    "account": _table(_BLANKS + b"\"'"),
    "literal": _table(_ALNUM + b"+/_.=-", True),
    # Prose: no wide character either, whose first byte is one of these.
    "prose": _table(_BLANKS + b"\"'`(){}[]<>" + bytes(range(0xE3, 0xEA)) + b"\xef"),
}

_FORMAT = re.compile(
    r"(?<![A-Za-z0-9])(?:[a-z][a-z0-9]{1,7}_(?:live|prod|srv|test|dev)_[A-Za-z0-9]{16,}"
    r"|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}|gh[pousr]_[A-Za-z0-9]{30,}|AKIA[0-9A-Z]{16}(?![0-9A-Z])"
    r"|xox[abprs]-[A-Za-z0-9-]{20,}|AIza[A-Za-z0-9_-]{30,}|sk-[A-Za-z0-9_-]{20,})",
)
_LABEL_END = re.compile(rf"(?:(?<![A-Za-z0-9])|(?<=[a-z0-9])(?=[A-Z]))(?P<label>(?i:{'|'.join(LABELS)}))\Z")
#: Bytes before a separator that hold any label, and the byte before it.
_HEAD = max(map(len, LABELS)) + 1
_PASSWORD = re.compile(r"(?i)pass|pwd|pw")
_CLOSED = {q: re.compile(b"(?:[^\\\\\n\xff" + q + b"]|\\\\[^\xff])*" + q) for q in (b'"', b"'", b"`")}
_CLOSED_TWICE = {q: re.compile(b"[^\\\\\n\xff" + q + b"]*\\\\" + q) for q in (b'"', b"'", b"`")}
_APPENDED = re.compile(rb"\s*\+\s*(?=[\"'`])")
_AMPERSAND = re.compile(rb"&[^\s\"'`,;&=(){}\[\]\xff]+(?=[\n;\xff]|\Z)")
_NAMED = re.compile(rb"([\w$.-]*)\\?[\"'`]?\s*([=:])\s*\\?[\"'`]\Z")
_LEAD = re.compile(rb"(?:[ \t]|\xe3\x80\x80)*[\"'`]?")
_SENTENCE = re.compile(r"[.!?]\s|[。！？\n]")
_WHOLE = re.compile(rf"(?i:^(?:{_ZH}|{_ABROAD})$|^(?:[a-z0-9.-]*[_.-])?{_LABEL.replace('(', '(?:', 1)}$|^(?:[a-z0-9_]*[a-z0-9])?(?-i:Password|Secret|Token|ApiKey)$)")
#: Names of values that are long and mixed but no secret.
_IDS = re.compile(r"(?i)(?:^|[^a-z])(?:(?:[a-z]+[_-]?)?ids?|sha\d*|md5|hash|digest|checksum|etag|commit|rev(?:ision)?|version|uuid|guid|nonce|integrity|fingerprint|ref|cursor|url|path|type|cert(?:ificate)?|public[_-]?key)$|I[Dd]s?$")

_PLACEHOLDER = re.compile(
    r"""(?ix)^(?: [<\[{(].*[>\]})]? | .*(?:\{\{|\$\{|\}\}).* | =.* | \$[a-z_]+\d? | \$[a-z_]\w*[.\[(].* | \$\(.* | %\w*%? | (.)\1* | [x*•.#-]+ | .*\*{3,}.*
        | (?:process\.env|os\.environ|env|vars|secrets|config|credentials|getenv|input|item|this|self|json)\b.*
        | .*(?:_here|-here)$ | your[_-].* | my[_-]?(?:api|access|auth|secret|private|client)?[_-]?(?:key|token|pass|password|secret|pwd)
        | .*(?:example|placeholder|changeme|change_me|redacted|dummy|sample).*
        | (?:null|none|nil|undefined|true|false|todo|tbd|n/?a|string|text|hidden) | \d{1,8} )$"""
)
_RANDOM = re.compile(r"^[0-9a-f]{40}$|^[A-Za-z0-9+/_-]{28,}={0,2}$|^[A-Za-z0-9._-]{40,}$")


def _classes(text: str) -> int:
    return sum(bool(re.search(c, text)) for c in ("[a-z]", "[A-Z]", "[0-9]", r"[^A-Za-z0-9\s]"))


def is_literal(value: str, password: bool = False, quoted: bool = False) -> bool:
    """Whether a labelled value can be a secret itself, not a placeholder, a reference or prose.

    Values labelled as passwords may also be short if they mix three kinds of characters, or, in quotes, one long word.
    """
    if not value or re.search(r"\s", value) or _PLACEHOLDER.match(value):
        return False
    kinds = _classes(value)
    if len(value) < 6:
        return password and kinds >= 3
    if kinds == 1:
        return password and quoted and len(value) >= 16 and value.isalpha()
    return bool(re.search("[A-Za-z0-9]{4}", value)) or password and kinds >= 3 and len(re.findall("[A-Za-z0-9]", value)) >= 4


def _is_random(value: str) -> bool:
    """Whether an unlabelled string literal looks like key material: long, unbroken, mixed."""
    if not _RANDOM.match(value) or _PLACEHOLDER.match(value):
        return False
    return bool(re.search("[0-9]", value)) and bool(re.search("[A-Za-z]", value)) and not re.fullmatch(r"[a-z]+(?:[-_][a-z0-9]+)*", value)


class _Row:
    """The spans of one value from the places that the automaton marked in it; places are those of the buffer."""

    def __init__(self, buffer: bytes, start: int, end: int, name: str):
        self.buffer, self.start, self.end, self.name = buffer, start, end, name
        self.found: list[tuple[int, int, str]] = []
        self.blocks: list[tuple[int, int]] = []  # armored texts of any kind

    def text(self, a: int, b: int) -> str:
        return self.buffer[a:b].decode("utf-8", "replace")

    def add(self, a: int, b: int, kind: str) -> None:
        if not any(x < b and a < y for x, y in self.blocks):
            self.found.append((a, b, kind))

    def armor(self, place: int) -> None:
        at = self.buffer.rfind(b"-----BEGIN ", self.start, place - 5)
        if at < 0:
            return
        label = self.buffer[at + 11 : place - 5]
        end = self.buffer.find(b"-----END " + label + b"-----", place, self.end)
        end = self.end if end < 0 else end
        self.blocks.append((at, end))
        body = self.buffer[place:end]
        if re.fullmatch(rb"[A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?", label) and len(re.findall(rb"[A-Za-z0-9+/=]", body)) >= 32 and b"*****" not in body:
            self.found.append((place, end, "private_key"))

    def format(self, a: int, b: int) -> None:
        for m in _FORMAT.finditer(self.text(a, b)):
            if not _PLACEHOLDER.match(m[0]):
                self.add(a + m.start(), a + m.end(), "token")

    def plain(self, a: int, b: int, kind: str, password: bool = True) -> None:
        if b > a and is_literal(self.text(a, b), password):
            self.add(a, b, kind)

    def quoted(self, a: int) -> list[tuple[int, int]]:
        """The span of the literal that begins at ``a``, and those of literals that code appends to it; none if it isn't closed."""
        quote = self.buffer[a - 1 : a]
        escaped = self.buffer[a - 2 : a - 1] == b"\\" and a - 2 >= self.start
        m = escaped and _CLOSED_TWICE[quote].match(self.buffer, a, self.end) or _CLOSED[quote].match(self.buffer, a, self.end)
        if not m:
            return []
        spans = [(a, m.end() - (2 if self.buffer[m.end() - 2 : m.end() - 1] == b"\\" and escaped else 1))]
        while more := _APPENDED.match(self.buffer, m.end(), self.end):
            quote = self.buffer[more.end() : more.end() + 1]
            following = _CLOSED[quote].match(self.buffer, more.end() + 1, self.end)
            if not following:
                break
            m = following
            spans.append((more.end() + 1, m.end() - 1))
        return spans

    def labelled(self, a: int, b: int) -> None:
        """A value after a label and ``:`` or ``=``; ``b`` is where an unquoted one ends."""
        i = a
        back = self.buffer
        low = self.start
        quote = back[i - 1 : i] if i > low and back[i - 1 : i] in (b'"', b"'", b"`") else b""
        i -= len(quote)
        if i > low and back[i - 1] == 0x5C:
            i -= 1
        while i > low and back[i - 1] in b" \t":
            i -= 1
        if i <= low or back[i - 1] not in b":=":
            return
        i -= 1
        while i > low and back[i - 1] in b" \t":
            i -= 1
        if i > low and back[i - 1] in b"\"'`":
            i -= 1
            if i > low and back[i - 1] == 0x5C:
                i -= 1
        m = _LABEL_END.search(back[max(low, i - _HEAD) : i].decode("latin-1"))
        if not m:
            return
        if quote:
            spans = self.quoted(a)
        else:
            more = _AMPERSAND.match(back, b, self.end)
            spans = [(a, more.end() if more else b)]
            if back[spans[0][1] : spans[0][1] + 1] in (b"(", b"[", b"{"):
                return  # a call
        whole = "".join(self.text(*x) for x in spans)
        if not quote:  # a wide mark or space ends it as well
            whole = re.split(r"[\s\u3000-\u303f\uff00-\uff60]", whole, maxsplit=1)[0]
            spans = [(a, a + len(whole.encode()))]
        password = bool(_PASSWORD.match(m["label"]))
        if re.match(r"(?i)(bearer|basic)\b", whole) or not quote and re.fullmatch(r"[A-Za-z_$]+(?:\.[A-Za-z_$]+)+", whole):
            return  # a scheme, or a reference such as settings.key
        if is_literal(whole, password, bool(quote)):
            for x in spans:
                self.add(*x, "password" if password else "token")

    def literal(self, a: int) -> None:
        """An unlabelled string literal of random characters."""
        spans = self.quoted(a)
        if not _is_random("".join(self.text(*x) for x in spans)):
            return
        before = _NAMED.search(self.buffer[max(self.start, a - 200) : a])
        if before and before[2] == b":" and _IDS.search(before[1].decode("latin-1")):
            return  # an id or a checksum
        for x in spans:
            self.add(*x, "token")

    def prose(self, a: int, stops: np.ndarray) -> None:
        """A value after a label of prose: blanks and a quote may come first, a sentence's mark last."""
        a = _LEAD.match(self.buffer, a, self.end).end()
        b = min(int(stops[np.searchsorted(stops, a)]), self.end)
        while b > a and self.buffer[b - 1] in b".,;:":
            b -= 1
        if not self.buffer[a:b].lower().startswith((b"http://", b"https://")):
            self.plain(a, b, "password")

    def named(self) -> None:
        """The whole value of a parameter whose own name is a label."""
        if not self.found and _WHOLE.match(self.name):
            value = self.text(self.start, self.end)
            bare = value.strip()
            if is_literal(bare, bool(_PASSWORD.search(self.name))):
                at = self.start + len(value[: value.index(bare)].encode())
                self.found.append((at, at + len(bare.encode()), "password"))

    def spans(self) -> list[tuple[int, int, str]]:
        """Byte spans within the value, merged and in order."""
        merged: list[tuple[int, int, str]] = []
        for a, b, kind in sorted(self.found):
            a, b = a - self.start, b - self.start
            if merged and a < merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]), merged[-1][2])
            elif b > a:
                merged.append((a, b, kind))
        return merged


def spans_of(automaton: Automaton, names: pa.Array, values: pa.Array) -> Iterator[tuple[int, bytes, list[tuple[int, int, str]]]]:
    """``(row, value, spans)`` of the values that hold a secret; spans are in bytes. Null names count as empty, null values hold none."""
    names = pc.fill_null(names.cast(pa.large_binary()), b"")
    values = pc.fill_null(values.cast(pa.large_binary()), b"")
    reset = pa.scalar(b"\xff", pa.large_binary())
    laid = pc.binary_join_element_wise(reset, names, values, pa.scalar(b"=", pa.large_binary()))
    edges = np.frombuffer(laid.buffers()[1], np.int64)[laid.offset : laid.offset + len(laid) + 1]
    buffer = bytes(laid.buffers()[2] or b"")[: edges[-1]] + b"\xff"
    data = np.frombuffer(buffer, np.uint8)
    starts = edges[:-1] + 3 + pc.binary_length(names).to_numpy(zero_copy_only=False)
    places, bits = automaton.scan(data)
    row_of = np.searchsorted(edges, places - 1, "right") - 1
    here = places > starts[np.minimum(row_of, len(starts) - 1)]
    places, bits, row_of = places[here], bits[here], row_of[here]
    stops = {kind: np.flatnonzero(table[data]) for kind, table in _STOPS.items()}

    def end_of(kind, at):
        return stops[kind][np.searchsorted(stops[kind], at)]

    found: dict[int, list[tuple]] = {}
    for kind in ("armor", "format", "connection", "labelled", "scheme", "account", "literal", "abroad", "slash"):
        own = np.flatnonzero(bits & _BIT[kind])
        at, rows = places[own] - 1, row_of[own]
        ends = end_of({"labelled": "raw", "abroad": "prose", "slash": "prose", "armor": "raw"}.get(kind, kind), at)
        if kind == "connection":
            fine = data[ends] == ord("@")
            fine &= ~np.isin(data[np.minimum(ends + 1, len(data) - 1)], list(_BLANKS + b"/@\xff"))
        elif kind == "literal":  # too short to be random, unless code appends more
            fine = ends - at >= 28
            short = np.flatnonzero(~fine & np.isin(data[ends], list(b"\"'`")))
            fine[short] = np.isin(data[np.minimum(ends[short] + 1, len(data) - 1)], list(_BLANKS + b"+"))
        elif kind == "scheme":
            fine = ends - at >= 8
        elif kind == "format":
            at = stops["format"][np.searchsorted(stops["format"], at) - 1] + 1
            fine = ends - at >= 16
        else:
            fine = np.ones(len(at), bool)
        for r, a, b in dict.fromkeys(zip(rows[fine].tolist(), at[fine].tolist(), ends[fine].tolist())):
            found.setdefault(r, []).append((kind, a, b))
    logins = places[(bits & _BIT["login"]) != 0]
    named = [r for r, x in enumerate(names.to_pylist()) if _WHOLE.match(x.decode("utf-8", "replace"))] if len(names) else []
    for r in sorted({*found, *named}):
        name = names[r].as_py().decode("utf-8", "replace")
        row = _Row(buffer, int(starts[r]), int(edges[r + 1]), name)
        for kind, a, b in found.get(r, ()):
            if kind == "armor":
                row.armor(a + 1)
            elif kind == "format":
                row.format(max(a, row.start), b)
            elif kind == "labelled":
                row.labelled(a, b)
            elif kind == "literal":
                row.literal(a)
            elif kind == "abroad":
                if _boundary(row, a + 1):
                    row.prose(a + 1, stops["prose"])
            elif kind == "slash":
                k = int(np.searchsorted(logins, a)) - 1
                if k >= 0 and logins[k] > row.start and not _SENTENCE.search(row.text(int(logins[k]), a)):
                    row.prose(a, stops["prose"])
            elif kind == "account":
                row.plain(a, b, "password")
            else:
                row.plain(a, b, "password" if kind == "connection" else "token", kind == "connection")
        row.named()
        if spans := row.spans():
            yield r, buffer[row.start : row.end], spans


def _boundary(row: _Row, place: int) -> bool:
    """Whether the label that ends before ``place`` begins a word; Chinese ones stand amid other characters."""
    at = place - (1 if row.buffer[place - 1] < 0x80 else 3)  # before the separator
    end = at
    while end > row.start and row.buffer[end - 1] in _BLANKS:
        end -= 1
    head = row.text(max(row.start, end - _WIDEST), end)
    return bool(_ABROAD_END.search(head + row.text(at, place)))


_ABROAD_END = re.compile(
    rf"(?i:(?:{_ZH}[\"'`]?[:=：＝是为為]|(?<![^\W_]){_ABROAD}[\"'`]?[:=：＝]|(?<![A-Za-z0-9]){_LABEL}[\"'`]?[：＝]))\Z"
)
#: Bytes that hold any of those labels, a quote, and the character before.
_WIDEST = 3 * max(map(len, (*LABELS_ZH, *LABELS_ABROAD, *LABELS))) + 5


@lru_cache(1)
def automaton() -> Automaton:
    """The automaton of all grammars; its size is theirs."""
    return Automaton(list(PATTERNS.values()), ignore_case=True)


def secret_spans(name: str, value: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the secrets in a parameter's value, in characters, merged and in order."""
    for _, raw, spans in spans_of(automaton(), pa.array([name]), pa.array([value])):
        return _in_characters(raw, spans)
    return []


def _in_characters(raw: bytes, spans):
    return [(len(raw[:a].decode("utf-8", "replace")), len(raw[:b].decode("utf-8", "replace")), kind) for a, b, kind in spans]


def redact(value: str, spans: list[tuple[int, int, str]]) -> str:
    """The value with each span replaced; a placeholder is no secret, so redacting twice changes nothing."""
    out, at = [], 0
    for a, b, kind in spans:
        out += [value[at:a], f"<{kind}-redacted>"]
        at = b
    return "".join([*out, value[at:]])


def _masked(raw: bytes, spans: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for a, b, kind in spans:
        out += [raw[at:a], f"<{kind}-redacted>".encode()]
        at = b
    return b"".join([*out, raw[at:]]).decode("utf-8", "replace")


def _pieces(values: pa.Array, rows: int = 20_000, size: int = 8_000_000) -> Iterator[tuple[int, int]]:
    """Stretches of rows of a bounded number of bytes; a longer value is a stretch of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right"))
        to = min(max(to, at + 1), at + rows)
        yield at, to
        at = to


def _scan(shipped):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in _pieces(batch.column(3)):
                part = batch.slice(at, to - at)
                keep, masked, kinds, starts = [], [], [], []
                for row, raw, spans in spans_of(shipped.value, part.column(2), part.column(3)):
                    keep.append(row)
                    masked.append(_masked(raw, spans))
                    kinds.append([s[2] for s in spans])
                    starts.append([s[0] for s in _in_characters(raw, spans)])
                found = part.select([0, 1, 2]).take(pa.array(keep, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*found.columns, pa.array(masked, pa.string()), pa.array(kinds, pa.list_(pa.string())), pa.array(starts, pa.list_(pa.int32()))],
                    names=["file_id", "node_pos", "param", "masked", "kinds", "starts"],
                )

    return run


def compiled(spark: SparkSession):
    """The automaton as a broadcast; its size is that of the grammars."""
    return spark.sparkContext.broadcast(automaton())


def parameters(files: DataFrame) -> DataFrame:
    """``(file_id, node_pos, param, value)`` of all non-null parameter values."""
    nodes = files.select("file_id", F.posexplode("nodes").alias("node_pos", "node"))
    rows = nodes.select("file_id", "node_pos", F.explode("node.parameters").alias("param", "value"))
    return rows.where(F.col("value").isNotNull())


def find_secrets(values: DataFrame) -> DataFrame:
    """``(file_id, node_pos, param, masked, kinds, starts)`` of parameters that hold a secret.

    ``values`` is as of ``parameters``; null and empty values hold none, long ones are read whole. One
    pass without a shuffle. A file delivered twice gives its rows twice.
    """
    schema = "file_id long, node_pos int, param string, masked string, kinds array<string>, starts array<int>"
    wanted = values.select(F.col("file_id").cast("long").alias("file_id"), "node_pos", "param", "value").where(F.length("value") > 0)
    return wanted.mapInArrow(_scan(compiled(values.sparkSession)), schema)


def _redact_nodes(shipped):
    def run(nodes: pa.Array) -> pa.Array:
        nodes = nodes.combine_chunks() if isinstance(nodes, pa.ChunkedArray) else nodes
        if nodes.offset or not len(nodes):
            nodes = nodes.take(pa.array(np.arange(len(nodes))))
        items = nodes.values
        maps = items.field("parameters")
        names, values = maps.keys, maps.items
        rows, masked = [], []
        for at, to in _pieces(values):
            for row, raw, spans in spans_of(shipped.value, names[at:to], values[at:to]):
                rows.append(at + row)
                masked.append(_masked(raw, spans))
        if not rows:
            return nodes
        hit = np.zeros(len(values), bool)
        hit[rows] = True
        new = pc.replace_with_mask(values, pa.array(hit), pa.array(masked, values.type))
        new = pa.MapArray.from_buffers(maps.type, len(maps), maps.buffers()[:2], maps.null_count, maps.offset, [pa.StructArray.from_arrays([names, new], fields=[maps.type.key_field, maps.type.item_field])])
        fields = [new if f.name == "parameters" else items.field(k) for k, f in enumerate(items.type)]
        new = pa.StructArray.from_arrays(fields, fields=list(items.type), mask=items.is_null())
        return pa.ListArray.from_buffers(nodes.type, len(nodes), nodes.buffers()[:2], nodes.null_count, nodes.offset, [new])

    return run


def redact_files(files: DataFrame) -> DataFrame:
    """The files with each secret masked in its parameter, and every other value, field and column as it was.

    Each row is changed where it lies, whatever its id: nothing is joined or shuffled, null and repeated ids do no harm.
    """
    nodes = F.arrow_udf(_redact_nodes(compiled(files.sparkSession)), files.schema["nodes"].dataType)
    return files.withColumn("nodes", nodes("nodes"))
