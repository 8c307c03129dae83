"""Byte-pair encoding by a token automaton.

Greedy merging never looks at more than two neighbours at a time, so the token sequences it
can produce form a regular language. Its automaton has one state per token (the token read
last). It starts with an arc per byte; the gadget of merge ``k``: ``left + right -> new`` adds
an arc ``new`` wherever ``left`` then ``right`` could be read, gives the state of ``new`` the
arcs that ``right``'s state has at that moment, and removes the arc ``right`` from ``left``'s
state. Written out that is a table of vocabulary x vocabulary; but a row of it is another row
as it was at time ``k``, and likewise a column, so the arc ``x -> y`` is decided by walking
both tokens back through their gadgets. The compiled tables are the two parents and the time
of each token, the hashed gadget pairs, and a hashed byte trie.

A byte string has exactly one path through the automaton, and so has each of its prefixes:
encoding keeps, per prefix, the token its path ends with. Words are run in lockstep, thousands
at a time, by table lookups in NumPy. Where only few words have a length, such as long rules or blobs,
each is read byte by byte instead: links from every trie node to the longest token that ends there, and
from a token to the next shorter one, lead to the first token that fits, so time grows with the bytes.
"""

from __future__ import annotations

import json
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType

#: Splits a text before the merges apply (the published pattern of the 50k byte-level vocabulary).
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"

_NEVER = np.int64(1) << 40
#: Words a worker remembers before it starts afresh; bounds its memory, not the result.
_REMEMBERED = 150_000
_REMEMBERED_BYTES = 16_000_000
#: Fewer words of a length than this are read byte by byte.
_FEW = 40


def printable_bytes() -> list[str]:
    """The character that stands for each byte in byte-level vocabulary files.

    Printable Latin-1 bytes stand for themselves, the others for the code points from 256 on.
    """
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


class _Hash:
    """int64 -> int32 by open addressing; -1 where a key is absent."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(2.5 * len(keys) + 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        at, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = self.keys[at[todo]] < 0
            self.keys[at[todo[free]]] = keys[todo[free]]
            won = self.keys[at[todo]] == keys[todo]
            self.values[at[todo[won]]] = values[todo[won]]
            todo = todo[~won]
            at[todo] = (at[todo] + 1) & self.mask

    def _slot(self, keys):
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], np.int32(-1))
        todo = np.flatnonzero((found != keys) & (found >= 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & self.mask
            found = self.keys[at[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self.values[at[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
        return out


class MergeAutomaton:
    """The compiled automaton of one byte-level vocabulary; a few megabytes, whatever the data."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        symbols = printable_bytes()
        to_byte = {c: b for b, c in enumerate(symbols)}
        n = max(vocabulary.values()) + 1
        self.byte_token = np.array([vocabulary[c] for c in symbols], np.int32)
        self.left, self.right = np.full(n, -1, np.int32), np.full(n, -1, np.int32)
        self.time = np.full(n, -1, np.int64)
        for k, (a, b) in enumerate(merges):
            new = vocabulary[a + b]
            if self.time[new] >= 0:
                raise ValueError(f"two merges make {a + b!r}; their automaton is not deterministic")
            self.left[new], self.right[new], self.time[new] = vocabulary[a], vocabulary[b], k
        made = np.flatnonzero(self.time >= 0)
        self.pairs = _Hash(self.left[made].astype(np.int64) << 32 | self.right[made], self.time[made].astype(np.int32))
        # An arc enters the automaton only if its two parts could be read one after the other.
        readable = np.zeros(n, bool)
        readable[self.byte_token] = True
        fits = np.zeros(n, bool)
        fits[made] = self._follows(self.left[made], self.right[made], self.time[made])
        for new in made[np.argsort(self.time[made])]:
            readable[new] = fits[new] and readable[self.left[new]] and readable[self.right[new]]
        self._trie([(bytes(to_byte[c] for c in s), i) for s, i in vocabulary.items() if readable[i]])
        self.labels = [b""] * n
        for s, i in vocabulary.items():
            if all(c in to_byte for c in s):
                self.labels[i] = bytes(to_byte[c] for c in s)

    @classmethod
    def load(cls, path: str) -> MergeAutomaton:
        model = json.load(open(path, encoding="utf-8"))["model"]
        return cls(model["vocab"], [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]])

    def _trie(self, tokens: list[tuple[bytes, int]]) -> None:
        nodes, arcs = {b"": 0}, []
        token_at = [-1]
        for label, token in sorted(tokens):
            for end in range(1, len(label) + 1):
                if label[:end] not in nodes:
                    nodes[label[:end]] = len(nodes)
                    arcs.append((nodes[label[: end - 1]] << 8 | label[end - 1], nodes[label[:end]]))
                    token_at.append(-1)
            token_at[nodes[label]] = token
        keys, values = np.array(arcs, np.int64).T
        self.arcs = _Hash(keys, values.astype(np.int32))
        self.first = self.arcs.get(np.arange(256))
        self.second = self.arcs.get((self.first.astype(np.int64)[:, None] << 8 | np.arange(256)).ravel())
        self.token_at = np.array(token_at, np.int32)
        # Per node, the node of its longest proper suffix; by depth, so that a suffix comes before.
        children: list[list[tuple[int, int]]] = [[] for _ in nodes]
        for key, node in arcs:
            children[key >> 8].append((key & 255, node))
        fail, onward, todo = [0] * len(nodes), dict(arcs), [0]
        for node in todo:  # grows while it is read
            for byte, child in children[node]:
                at = fail[node]
                while node and at and (at << 8 | byte) not in onward:
                    at = fail[at]
                fail[child] = onward.get(at << 8 | byte, 0) if node else 0
                todo.append(child)
        # The longest token that ends at a node, and the next shorter one that ends where a token does.
        ending, self.shorter = [-1] * len(nodes), np.full(len(self.left), -1, np.int32)
        for node in todo[1:]:
            ending[node] = token_at[node] if token_at[node] >= 0 else ending[fail[node]]
            if token_at[node] >= 0:
                self.shorter[token_at[node]] = ending[fail[node]]
        self.fail, self.ending = np.array(fail, np.int32), np.array(ending, np.int32)
        self.depth = np.zeros(len(self.left), np.int32)
        for label, token in tokens:
            self.depth[token] = len(label)
        self.by_byte = None

    def _follows(self, x: np.ndarray, y: np.ndarray, now: np.ndarray | None = None) -> np.ndarray:
        """Whether the state of ``x`` has the arc ``y`` when the gadgets before ``now`` (all) are in."""
        ok = np.ones(len(x), bool)
        x, y = x.astype(np.int64), y.astype(np.int64)
        now = np.full(len(x), _NEVER) if now is None else now.astype(np.int64)
        live = np.arange(len(x))
        while len(live):
            gadget = self.pairs.get(x[live] << 32 | y[live])
            cut = (gadget >= 0) & (gadget < now[live])
            ok[live[cut]] = False
            live = live[~cut]
            tx, ty = self.time[x[live]], self.time[y[live]]
            more = (tx >= 0) | (ty >= 0)
            live, tx, ty = live[more], tx[more], ty[more]
            # The younger token's row or column is its parent's, as it was when it was made. Of two
            # places where one merge applies the left one is merged first, so it counts as older.
            older = tx > ty
            a, b = live[older], live[~older]
            now[a], x[a] = tx[older], self.right[x[a]]
            now[b], y[b] = ty[~older] + 1, self.left[y[b]]
        return ok

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all (non-empty) words in one array, and each word's first place and number of ids."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(size, kind="stable")
        by_size = size[order]
        flat, number, at = [np.empty(0, np.int32)], np.zeros(len(words), np.int64), 0
        while at < len(order):
            longest = int(by_size[at]) * 4 // 3 + 6  # shorter words are padded up to this
            end = min(int(np.searchsorted(by_size, longest, "right")), at + max(1, 400_000 // longest))
            some = order[at:end]
            group = [words[j] for j in some.tolist()]
            if len(group) < _FEW:
                lists = [self._encode_long(w) for w in group]
                ids, number[some] = np.array([i for x in lists for i in x], np.int32), [len(x) for x in lists]
            else:
                ids, number[some] = self._encode_group(group, by_size[at:end])
            flat.append(ids)
            at = end
        start = np.empty(len(words), np.int64)
        start[order] = np.cumsum(number[order]) - number[order]
        return np.concatenate(flat), start, number

    def _encode_long(self, word: bytes) -> list[int]:
        """The ids of one word, byte by byte."""
        if self.by_byte is None:  # made by the process that meets a long word
            here = self.arcs.keys >= 0
            gadgets = self.pairs.keys >= 0
            self.by_byte = (
                dict(zip(self.arcs.keys[here].tolist(), self.arcs.values[here].tolist())), dict(zip(self.pairs.keys[gadgets].tolist(), self.pairs.values[gadgets].tolist())),
                *(x.tolist() for x in (self.fail, self.ending, self.shorter, self.depth, self.left, self.right, self.time)), {},
            )
        arcs, pairs, fail, ending, shorter, depth, left, right, time, known = self.by_byte
        if len(known) > 1_000_000:
            known.clear()

        def fits(x, y):
            now = 1 << 40
            while True:
                gadget = pairs.get(x << 32 | y)
                if gadget is not None and gadget < now:
                    return False
                tx, ty = time[x], time[y]
                if tx < 0 and ty < 0:
                    return True
                if tx > ty:
                    now, x = tx, right[x]
                else:
                    now, y = ty + 1, left[y]

        last, node = [-1] * (len(word) + 1), 0
        for end, byte in enumerate(word, 1):
            while node and (node << 8 | byte) not in arcs:
                node = fail[node]
            node = arcs.get(node << 8 | byte, 0)
            token = ending[node]
            while token >= 0:
                start = end - depth[token]
                if not start:
                    break
                pair = last[start] << 32 | token
                fine = known.get(pair)
                if fine is None:
                    fine = known[pair] = fits(last[start], token)
                if fine:
                    break
                token = shorter[token]
            if token < 0:
                raise ValueError("a byte string has no path; the vocabulary lacks a byte")
            last[end] = token
        out, end = [], len(word)
        while end:
            out.append(last[end])
            end -= depth[last[end]]
        return out[::-1]

    def _encode_group(self, words: list[bytes], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, length = len(words), int(size[-1])
        data = np.frombuffer(b"".join([w.ljust(length, b"\0") for w in words]), np.uint8).reshape(n, length).T.astype(np.int64)
        last = np.full((length + 1, n), -1, np.int32)  # the token that the path of each prefix ends with
        came = np.zeros((length + 1, n), np.int32)  # and the place where that token starts
        for start in range(length):
            live, node = np.arange(n), self.first[data[start]]
            for end in range(start + 1, length + 1):
                if end == start + 2:
                    node = self.second[data[start] << 8 | data[start + 1]]
                elif end > start + 2:
                    node = self.arcs.get(node.astype(np.int64) << 8 | data[end - 1][live])
                if end > start + 1:
                    on = np.flatnonzero(node >= 0)
                    live, node = live[on], node[on]
                    if not len(live):
                        break
                token = self.token_at[node]
                there = np.flatnonzero((token >= 0) & (last[end][live] < 0))
                if start and len(there):
                    there = there[self._follows(last[start][live[there]], token[there])]
                row = live[there]
                last[end][row] = token[there]
                came[end][row] = start
        if (last[length] < 0).any():
            raise ValueError("a byte string has no path; the vocabulary lacks a byte")
        rows, end, path = np.arange(n), size, []  # what follows a word's end has no part in its path
        while end.any():
            path.append(np.where(end > 0, last[end, rows], -1))
            end = came[end, rows] * (end > 0)
        path = np.array(path[::-1]).T
        return path[path >= 0], (path >= 0).sum(1)


class TextEncoder:
    """Texts to ids; remembers the words it met, since natural texts repeat most of theirs."""

    def __init__(self, automaton: MergeAutomaton, pattern: str = WORD_PATTERN):
        self.automaton, self.find = automaton, regex.compile(pattern).findall
        self._forget()

    def _forget(self):
        self.known, self.flat, self.bytes = {}, np.empty(0, np.int32), 0
        self.start, self.number = np.empty(0, np.int64), np.empty(0, np.int64)

    def _look_up(self, texts):
        """The place of every word of the texts among the known ones, and the words per text."""
        split = [self.find(t) if t else [] for t in texts]
        words = list(chain.from_iterable(split))
        fresh = set(words).difference(self.known)
        more = sum(map(len, fresh))
        if len(self.known) + len(fresh) > _REMEMBERED or self.bytes + more > _REMEMBERED_BYTES:
            self._forget()
            fresh = set(words)
            more = sum(map(len, fresh))
        self.bytes += more
        if fresh:
            flat, start, number = self.automaton.encode_words([w.encode() for w in fresh])
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh))))
            self.start = np.concatenate([self.start, start + len(self.flat)])
            self.number = np.concatenate([self.number, number])
            self.flat = np.concatenate([self.flat, flat])
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)), np.array(list(map(len, split)), np.int64)

    def _chunks(self, texts, characters=2_000_000):
        chunk, size = [], 0
        for text in texts:
            chunk.append(text)
            size += len(text or "")
            if size > characters:
                yield chunk
                chunk, size = [], 0
        if chunk:
            yield chunk

    def _counts(self, place, words_per_text):
        ends = np.concatenate([[0], np.cumsum(self.number[place])])
        return np.diff(ends[np.concatenate([[0], np.cumsum(words_per_text)])])

    def encode(self, texts) -> pa.Array:
        """A list of ids per text; null and empty texts give empty lists."""
        values, lengths = [np.empty(0, np.int32)], [np.zeros(1, np.int64)]
        for chunk in self._chunks(texts):
            place, words_per_text = self._look_up(chunk)
            number = self.number[place]
            ends = np.cumsum(number)
            values.append(self.flat[np.repeat(self.start[place] - ends + number, number) + np.arange(number.sum())])
            lengths.append(self._counts(place, words_per_text))
        offsets = np.cumsum(np.concatenate(lengths)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values)))

    def count(self, texts) -> pa.Array:
        """The number of ids per text."""
        return pa.array(np.concatenate([np.empty(0, np.int64), *(self._counts(*self._look_up(c)) for c in self._chunks(texts))]))


_ENCODERS: dict[int, TextEncoder] = {}


def _encoder(shipped, pattern) -> TextEncoder:
    """One encoder per Python worker, kept between tasks."""
    key = hash((id(shipped.value), pattern))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = TextEncoder(shipped.value, pattern)
    return _ENCODERS[key]


def compiled(spark: SparkSession, vocabulary: str = DEFAULT_VOCABULARY):
    """The automaton as a broadcast; its size is that of the vocabulary, not of the data."""
    return spark.sparkContext.broadcast(MergeAutomaton.load(vocabulary))


def encode(text: Column, shipped, pattern: str = WORD_PATTERN) -> Column:
    """Ids of ``text`` by a ``compiled`` automaton; null and empty texts give an empty list.

    Strings of special tokens are ordinary text. Any length of text is encoded whole.
    """

    def run(texts: pa.Array) -> pa.Array:
        return _encoder(shipped, pattern).encode(texts.to_pylist())

    return F.arrow_udf(run, ArrayType(IntegerType()))(text)


def count_tokens(text: Column, shipped, pattern: str = WORD_PATTERN) -> Column:
    """Number of ids of ``text``; 0 for null and empty texts."""

    def run(texts: pa.Array) -> pa.Array:
        return _encoder(shipped, pattern).count(texts.to_pylist())

    return F.arrow_udf(run, LongType())(text)


def decode(ids: Column, shipped) -> Column:
    """The text that a path emits; bytes that are no UTF-8 become U+FFFD, null ids a null text."""

    def run(lists: pa.Array) -> pa.Array:
        labels = shipped.value.labels
        return pa.array(
            [None if x is None else b"".join([labels[i] for i in x]).decode("utf-8", "replace") for x in lists.to_pylist()],
            pa.string(),
        )

    return F.arrow_udf(run, "string")(ids)


def encode_corpus(documents: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(id, ids)`` of each document; one pass, no shuffle. Null and empty texts give an empty list.

    Texts of any length are encoded whole. A row delivered twice gives its ids twice; other columns
    are not read.
    """
    shipped = compiled(documents.sparkSession, vocabulary)
    return documents.select(F.col(id_col), encode(F.col(text), shipped).alias("ids"))
