"""Nested JSON into linked flat tables, by vectorised structural indexing.

A batch of JSON texts is laid end to end. Bitmaps of quotes, brackets and delimiters outside of
strings give the tokens, prefix sums the nesting depth; sorting by depth then place finds each
token's container and its place among the container's elements. Every text's grammar is checked
on the token sequence, so a text that is cut off or broken gives no row at all.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STRING, SCALAR, OPEN_OBJECT, CLOSE_OBJECT, OPEN_LIST, CLOSE_LIST, COLON, COMMA = range(8)
_KIND = np.full(256, -1, np.int8)
for _kind, _char in ((OPEN_OBJECT, "{"), (CLOSE_OBJECT, "}"), (OPEN_LIST, "["), (CLOSE_LIST, "]"), (COLON, ":"), (COMMA, ",")):
    _KIND[ord(_char)] = _kind
_SPACE = np.isin(np.arange(256), list(b" \t\r\n"))
_ESCAPES = np.isin(np.arange(256), list(b'"\\/bfnrtu'))
_HEX = np.isin(np.arange(256), list(b"0123456789abcdefABCDEF"))
_NUMBER = re.compile(rb"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null")


def _slices(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The given stretches of a buffer as an array of byte strings."""
    size = end - start
    ends = np.cumsum(size)
    flat = data[np.repeat(start - ends + size, size) + np.arange(int(size.sum()))]
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])


def sound(text: str) -> str:
    """The text with halves of surrogate pairs that stand alone, which JSON's escapes allow, as U+FFFD."""
    return re.sub("[\ud800-\udfff]", "\ufffd", text)


class StructuralIndex:
    """Tokens of a batch of JSON texts.

    Per token: ``text`` (its row), ``kind``, ``start``, ``end``, ``box`` (the token that opened the
    container it is in, -1 at the top), ``place`` (0-based, among the container's elements), ``key``
    (the token of its field name, -1 in lists). ``valid`` tells of each text whether it is JSON.
    """

    def __init__(self, texts: list[bytes]):
        self.data = data = np.frombuffer(b"".join(texts), np.uint8)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(size)
        begin = ends - size
        n = len(data)
        row_of = np.repeat(np.arange(len(texts)), size)
        spot = np.arange(n)
        slash = data == 92
        # A character is escaped if the run of backslashes before it, within its text, is odd.
        last = np.maximum.accumulate(np.where(slash, -1, spot)) if n else spot
        last = np.maximum(last, begin[row_of] - 1)
        run = np.zeros(n, np.int64)
        run[1:] = np.where(slash[:-1], spot[:-1] - last[:-1], 0)
        run[begin[size > 0]] = 0
        escaped = run % 2 == 1
        quote = (data == 34) & ~escaped
        count = np.cumsum(quote)
        base = np.where(begin > 0, count[np.maximum(begin - 1, 0)], 0) if n else np.zeros(len(texts), np.int64)
        inside = (count - base[row_of]) % 2 == 1  # true from the opening quote to before the closing one
        opening, closing = quote & inside, quote & ~inside
        quiet = ~inside & ~closing
        mark = np.where(quiet, _KIND[data], -1)
        plain = quiet & (mark < 0) & ~_SPACE[data]
        before = np.zeros(n, bool)
        before[1:] = plain[:-1]
        before[begin[size > 0]] = False
        scalar = plain & ~before
        mark = np.where(opening, STRING, np.where(scalar, SCALAR, mark))
        at = np.flatnonzero(mark >= 0)
        self.kind, self.text, self.start = mark[at], row_of[at], at
        self.end = at + 1
        strings = self.kind == STRING
        shut = np.flatnonzero(closing)
        to = np.searchsorted(shut, at[strings])
        self.end[strings] = np.where(to < len(shut), shut[np.minimum(to, len(shut) - 1)] + 1, n) if len(shut) else n
        scalars = self.kind == SCALAR
        after = plain.copy()
        after[:-1] &= ~plain[1:] | (row_of[1:] != row_of[:-1])
        self.end[scalars] = np.flatnonzero(after) + 1
        self.valid = self._check(row_of, inside, slash & ~escaped, quote, base, begin, ends, size)

    def _check(self, row_of, inside, escapes, quote, base, begin, ends, size):
        kind, text = self.kind, self.text
        m = len(kind)
        rows = len(size)
        bad = np.zeros(rows, bool)
        bad |= np.bincount(row_of[quote], minlength=rows) % 2 == 1
        data = self.data
        bad[row_of[inside & (data < 32)]] = True
        spot = np.flatnonzero(escapes & inside)
        follow = data[np.minimum(spot + 1, len(data) - 1)] if len(spot) else spot
        bad[row_of[spot[~_ESCAPES[follow]]]] = True
        for k in range(2, 6):
            own = spot[follow == ord("u")]
            if len(own):
                bad[row_of[own[~_HEX[data[np.minimum(own + k, len(data) - 1)]]]]] = True
        bad[row_of[np.flatnonzero(escapes & ~inside)]] = True
        opens = (kind == OPEN_OBJECT) | (kind == OPEN_LIST)
        closes = (kind == CLOSE_OBJECT) | (kind == CLOSE_LIST)
        level = np.cumsum(opens.astype(np.int64) - closes)
        first = np.searchsorted(text, np.arange(rows))
        base = np.concatenate([[0], level])[first] if m else np.zeros(rows, np.int64)
        level = level - base[text]
        bad[text[level < 0]] = True
        count = np.bincount(text, minlength=rows)
        bad |= count == 0
        final = first + count - 1
        bad[count > 0] |= level[final[count > 0]] != 0
        depth = level - opens  # of the container a bracket is in; inside, one more
        # Sorted by text, depth and place, a container's elements follow the token that opens it.
        inner = np.where(opens | closes, depth, level)
        joined = np.concatenate([inner, depth[opens] + 1])
        spots = np.concatenate([np.arange(m), np.flatnonzero(opens)])
        is_open = np.concatenate([np.zeros(m, bool), np.ones(int(opens.sum()), bool)])
        order = np.lexsort((~is_open, spots, joined, text[spots])) if m else np.empty(0, np.int64)
        spots, is_open, joined = spots[order], is_open[order], joined[order]
        here = np.arange(len(spots))
        opener = np.maximum.accumulate(np.where(is_open, here, -1)) if len(here) else here
        box = np.where((opener >= 0) & (joined > 0), spots[opener], -1)
        commas = np.cumsum((kind[spots] == COMMA) & ~is_open)
        place = commas - np.where(opener >= 0, commas[opener], 0)
        self.box, self.place = np.full(m, -1, np.int64), np.zeros(m, np.int64)
        self.box[spots[~is_open]], self.place[spots[~is_open]] = box[~is_open], place[~is_open]
        # A closing bracket lies in what holds its opener; what it closes is the last one opened there.
        shut = np.flatnonzero(closes)
        mate = self._mates(opens, closes, depth, text)
        bad[text[shut[mate < 0]]] = True
        pairs = mate >= 0
        bad[text[shut[pairs][kind[shut[pairs]] != kind[mate[pairs]] + 1]]] = True
        self.mate = np.full(m, -1, np.int64)
        self.mate[shut[pairs]] = mate[pairs]
        # Grammar: what may follow the token before, given the container.
        prev = np.full(m, -1, np.int64)
        if m:
            prev[1:] = kind[:-1]
            prev[first[count > 0]] = -1
        box_kind = np.where(self.box >= 0, kind[self.box], -1) if m else self.box
        in_object = box_kind == OPEN_OBJECT
        is_key = (kind == STRING) & in_object & ((prev == OPEN_OBJECT) | (prev == COMMA))
        after_key = np.zeros(m, bool)
        if m:
            after_key[1:] = is_key[:-1] & (text[1:] == text[:-1])
        value = (kind == STRING) | (kind == SCALAR) | opens
        shuts = np.where(closes, kind[self.mate], -1) if m else kind
        done = ((prev == STRING) & ~after_key) | (prev == SCALAR) | (prev == CLOSE_OBJECT) | (prev == CLOSE_LIST)
        ok = np.where(prev == -1, value, False)
        ok |= (prev == OPEN_OBJECT) & (is_key | ((kind == CLOSE_OBJECT) & (shuts == OPEN_OBJECT)))
        ok |= (prev == OPEN_LIST) & (value | ((kind == CLOSE_LIST) & (shuts == OPEN_LIST)))
        ok |= (prev == COMMA) & np.where(in_object, is_key, value & (box_kind == OPEN_LIST))
        ok |= (prev == COLON) & value
        ok |= after_key & (kind == COLON)
        ok |= done & (((kind == COMMA) & (self.box >= 0)) | closes)
        ok &= (kind != COLON) | after_key
        bad[text[~ok]] = True
        self.key = np.full(m, -1, np.int64)
        if m > 2:
            named = np.flatnonzero((prev == COLON) & value & in_object)
            self.key[named] = named - 2
        scalars = np.flatnonzero(kind == SCALAR)
        if len(scalars):
            found = _slices(data, self.start[scalars], self.end[scalars]).dictionary_encode()
            wrong = np.array([not _NUMBER.fullmatch(x) for x in found.dictionary.to_pylist()], bool)
            bad[text[scalars[wrong[found.indices.to_numpy()]]]] = True
        return ~bad

    @staticmethod
    def _mates(opens, closes, depth, text):
        """Of each closing bracket, the opening one: the last before it at the same depth of its text."""
        both = np.flatnonzero(opens | closes)
        order = both[np.lexsort((both, depth[both], text[both]))]
        shut = np.flatnonzero(closes)
        before = np.concatenate([[-1], order[:-1]]) if len(order) else order
        same = (before >= 0) & (text[before] == text[order]) & (depth[before] == depth[order]) & opens[before] & closes[order]
        mate = np.full(len(opens), -1, np.int64)
        mate[order[same]] = before[same]
        return mate[shut]

    def strings(self, tokens: np.ndarray) -> list[str | None]:
        """The decoded values of string tokens."""
        raw = _slices(self.data, self.start[tokens] + 1, self.end[tokens] - 1).to_pylist()
        return [sound(json.loads(b'"' + x + b'"')) if b"\\" in x else x.decode("utf-8", "replace") for x in raw]

    def is_named(self, tokens: np.ndarray, name: str) -> np.ndarray:
        """Whether the field name of each token is ``name``."""
        key = self.key[tokens]
        out = key >= 0
        own = key[out]
        plain = self.end[own] - self.start[own] == len(name.encode()) + 2
        some = np.flatnonzero(out)
        match = np.zeros(len(own), bool)
        match[plain] = _slices(self.data, self.start[own[plain]] + 1, self.end[own[plain]] - 1).to_numpy(zero_copy_only=False) == name.encode()
        # Names written with escapes are rare; they are decoded one by one.
        odd = np.flatnonzero(~plain)
        if len(odd):
            texts = _slices(self.data, self.start[own[odd]] + 1, self.end[own[odd]] - 1).to_pylist()
            match[odd] = [b"\\" in t and json.loads(b'"' + t + b'"') == name for t in texts]
        out[some] = match
        return out

    def up(self, tokens: np.ndarray, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """The containers of tokens, and whether they are of the given kind."""
        box = np.where(tokens >= 0, self.box[tokens], -1)
        return box, (box >= 0) & (self.kind[box] == kind)


def _elements_of(index: StructuralIndex, tokens: np.ndarray, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Of tokens in objects of a list that is the field ``name``: the object holding the list, and whether so."""
    items, a = index.up(tokens, OPEN_OBJECT)
    lists, b = index.up(items, OPEN_LIST)
    holder, c = index.up(lists, OPEN_OBJECT)
    ok = a & b & c
    ok[ok] = index.is_named(lists[ok], name)
    return np.where(ok, holder, -1), ok


def link_rows(index: StructuralIndex) -> tuple[np.ndarray, list, np.ndarray, list]:
    """Row, source name, slot and target name of each link: source -> port -> slots -> links -> node."""
    tokens = np.flatnonzero((index.kind == STRING) & (index.key >= 0) & index.valid[index.text])
    tokens = tokens[index.is_named(tokens, "node")]
    link, a = index.up(tokens, OPEN_OBJECT)
    slot, b = index.up(link, OPEN_LIST)
    port, c = index.up(slot, OPEN_LIST)
    source, d = index.up(port, OPEN_OBJECT)
    top, e = index.up(source, OPEN_OBJECT)
    ok = a & b & c & d & e & (index.box[np.maximum(top, 0)] < 0)
    tokens, slot, source = tokens[ok], slot[ok], source[ok]
    return index.text[tokens], index.strings(index.key[source]), index.place[slot], index.strings(tokens)


def rule_rows(index: StructuralIndex):
    """Rules (row, place, id) and conditions (row, rule id, place, id) of ``{values: [{id, conditions: {items: [{id}]}}]}``."""
    tokens = np.flatnonzero((index.kind == STRING) & (index.key >= 0) & index.valid[index.text])
    tokens = tokens[index.is_named(tokens, "id")]
    holder, of_rule = _elements_of(index, tokens, "values")
    of_rule &= index.box[np.maximum(holder, 0)] < 0
    rules = tokens[of_rule]
    rule_of = dict(zip(index.box[rules].tolist(), range(len(rules))))
    holder, of_item = _elements_of(index, tokens, "items")
    of_item[of_item] = index.is_named(holder[of_item], "conditions")
    items = tokens[of_item]
    owner = index.box[holder[of_item]]
    known = np.array([o in rule_of for o in owner.tolist()], bool)
    items, owner = items[known], owner[known]
    names = index.strings(rules)
    return (
        (index.text[rules], index.place[index.box[rules]], names),
        (index.text[items], [names[rule_of[o]] for o in owner.tolist()], index.place[index.box[items]], index.strings(items)),
    )


_CHUNK = 1_000_000


def _chunks(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Texts in stretches of a few megabytes, nulls as empty texts."""
    at, size, part = 0, 0, []
    for k, text in enumerate(column.cast(pa.binary()).to_pylist()):
        part.append(text or b"")
        size += len(part[-1])
        if size > _CHUNK:
            yield at, part
            at, size, part = k + 1, 0, []
    if part:
        yield at, part


_FLAT = "file_id long, kind string, parent string, slot int, child string"


def _flat(ids, kind, parents, slots, children):
    arrays = [pa.array(ids, pa.int64()), pa.array([kind] * len(children), pa.string()), pa.array(parents, pa.string())]
    return pa.RecordBatch.from_arrays(
        [*arrays, pa.array(slots, pa.int32()), pa.array(children, pa.string())], names=["file_id", "kind", "parent", "slot", "child"]
    )


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for at, texts in _chunks(batch.column(2)):
            rows, sources, slots, targets = link_rows(StructuralIndex(texts))
            names = [set(x or ()) for x in batch.column(1).slice(at, len(texts)).to_pylist()]
            real = np.array([s in names[r] and t in names[r] for r, s, t in zip(rows.tolist(), sources, targets)], bool)
            keep = np.flatnonzero(real)
            yield _flat(ids[rows[keep] + at], "link", [sources[k] for k in keep], slots[keep], [targets[k] for k in keep])


def _rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for at, texts in _chunks(batch.column(2)):
            rules, conditions = rule_rows(StructuralIndex(texts))
            names = batch.column(1).slice(at, len(texts)).to_pylist()
            yield _flat(ids[rules[0] + at], "rule", [names[r] for r in rules[0].tolist()], rules[1], rules[2])
            yield _flat(ids[conditions[0] + at], "condition", *conditions[1:])


def flatten_links(files: DataFrame) -> DataFrame:
    """Link rows between nodes of a file that exist; see ``flatten``."""
    rows = files.where(F.size("nodes") > 0).select(F.col("file_id").cast("long"), F.col("nodes.name").alias("names"), "connections")
    return rows.where(F.col("connections").rlike(r"^[ \t\r\n]*\{")).mapInArrow(_links, _FLAT)


def flatten_rules(files: DataFrame) -> DataFrame:
    """Rule and condition rows; see ``flatten``."""
    nodes = files.select(F.col("file_id").cast("long").alias("file_id"), F.explode("nodes").alias("node"))
    rows = nodes.select("file_id", F.col("node.name").alias("name"), F.col("node.parameters")["rules"].alias("rules"))
    return rows.where(F.col("rules").isNotNull()).mapInArrow(_rules, _FLAT)


def flatten(files: DataFrame) -> DataFrame:
    """``(file_id, kind, parent, slot, child)``: links, rules and conditions, each naming its parent.

    Files without nodes, null or broken JSON, null lists and elements, and elements without a text
    id give no row of their own; elements after them keep their places. Conditions of a rule without
    id have no parent to name and are left out. Rows are distinct. No shuffle but the last.
    """
    return flatten_links(files).union(flatten_rules(files)).distinct()


def node_table(files: DataFrame) -> DataFrame:
    """``(file_id, node_pos, id, name, type, type_version, n_parameters)``, one row per node."""
    rows = files.select("file_id", F.posexplode("nodes").alias("node_pos", "node"))
    count = F.coalesce(F.size("node.parameters"), F.lit(0))
    return rows.select(
        "file_id", "node_pos", "node.id", "node.name", "node.type", "node.type_version", F.when(count > 0, count).otherwise(0).alias("n_parameters")
    )
