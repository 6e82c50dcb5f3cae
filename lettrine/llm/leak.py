"""Evaluation texts inside documents.

The normalised items form one generalised suffix automaton over words.  Each
document is streamed through it; the state reached tells the longest run of words
that ends there and occurs in an item, and the items that hold it.

The items are the stated query set.  They are read in blocks of at most
``block_chars`` characters; each block is broadcast, made into an automaton on the
executors and run against all documents.  No document is shuffled.

Defined results: null and empty texts hold nothing and nothing is removed from
them; items shorter than ``min_words`` are never found; repeated rows give the
same rows once; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import unicodedata
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettrine.llm.base import WORD, _MARKS, words

MIN_WORDS = 12
#: A broadcast block of items holds at most so many characters, or one item if that is longer; results don't depend on it.
BLOCK_CHARS = 1_000_000


class Automaton:
    """Generalised suffix automaton over the words of items, with the items of each run of ``least`` words."""

    def __init__(self, items: list[tuple[int, str]], least: int):
        self.least = least
        self.ids: dict[str, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        self.n_words: dict[int, int] = {}
        texts = []
        for item, text in items:
            tokens = [self.ids.setdefault(w, len(self.ids)) for w in words(text)]
            self.n_words[item] = len(tokens)
            texts.append((item, tokens))
            last = 0
            for t in tokens:
                last = self._extend(last, t)
        #: The shortest state above each state that still holds ``least`` words; -1 if there is none.
        self.holder = [-1] * len(self.len)
        for v in sorted(range(len(self.len)), key=self.len.__getitem__):
            if self.len[v] >= least:
                up = self.link[v]
                self.holder[v] = v if self.len[up] < least else self.holder[up]
        self.items: dict[int, set[int]] = {}
        for item, tokens in texts:
            v = 0
            for n, t in enumerate(tokens, 1):
                v = self.next[v][t]
                if n >= least:
                    self.items.setdefault(self.holder[v], set()).add(item)

    def _new(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.len.append(length)
        self.link.append(link)
        return len(self.len) - 1

    def _split(self, p: int, q: int, t: int) -> int:
        clone = self._new(self.len[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(t) == q:
            self.next[p][t] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, t: int) -> int:
        q = self.next[last].get(t)
        if q is not None:
            return q if self.len[q] == self.len[last] + 1 else self._split(last, q, t)
        cur = self._new(self.len[last] + 1, {}, 0)
        p = last
        while p >= 0 and t not in self.next[p]:
            self.next[p][t] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][t]
            self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._split(p, q, t)
        return cur

    def stream(self, tokens: list[str]) -> Iterator[tuple[int, int, int]]:
        """(place of the last word, words matched, holder state) wherever at least ``least`` words match."""
        get, nxt, link, length, least, holder = self.ids.get, self.next, self.link, self.len, self.least, self.holder
        v = n = 0
        for i, w in enumerate(tokens):
            t = get(w)
            if t is None:
                v = n = 0
                continue
            edges = nxt[v]
            while t not in edges and v:
                v = link[v]
                n = length[v]
                edges = nxt[v]
            if t in edges:
                v = edges[t]
                n += 1
                if n >= least:
                    yield i, n, holder[v]
            else:
                n = 0


_built: dict[tuple[str, int], Automaton] = {}


def _automaton(shared, least: int) -> Automaton:
    """Of a broadcast block, which carries its own name; built once in each worker."""
    name, block = shared.value
    if (name, least) not in _built:
        _built.clear()
        _built[name, least] = Automaton(block, least)
    return _built[name, least]


def item_blocks(items: DataFrame, block_chars: int) -> Iterator[tuple[int, list[tuple[int, str]]]]:
    """(number of blocks, items) for each block of bounded size; each block is collected by itself."""
    items = items.select("item_id", "text").where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / block_chars))
    block = F.pmod(F.xxhash64("item_id"), F.lit(n))
    for b in range(n):
        yield n, [(r[0], r[1]) for r in (items if n == 1 else items.where(block == b)).collect()]


def leaks(documents: DataFrame, items: DataFrame, min_words: int = MIN_WORDS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, n_words, item_share): words of the document inside runs of at least ``min_words`` words of the item."""
    spark = documents.sparkSession
    out = None
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    for _, block in item_blocks(items, block_chars):
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, block))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            a = _automaton(shared, min_words)
            for batch in batches:
                rows = []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    seen: dict[int, list[int]] = {}
                    for i, _, state in a.stream(words(text.as_py() or "")):
                        for item in a.items[state]:
                            s = seen.setdefault(item, [-1, 0])
                            s[1] += i - max(s[0], i - min_words)
                            s[0] = i
                    rows.extend((doc, item, n, min(1.0, n / a.n_words[item])) for item, (_, n) in seen.items())
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.float64()))], names=["doc_id", "item_id", "n_words", "item_share"])

        found = docs.mapInArrow(run, "doc_id long, item_id long, n_words long, item_share double")
        out = found if out is None else out.unionByName(found)
    return out.distinct()


def _aligned(text: str) -> list[tuple[str, int, int]]:
    """The folded words of a text with the span of each in it."""
    chars, at = [], []
    for i, ch in enumerate(text):
        f = ch.casefold()
        f = f if f.isascii() else _MARKS.sub("", unicodedata.normalize("NFKD", f))
        chars.append(f)
        at.extend([i] * len(f))
    return [(m[0], at[m.start()], at[m.end() - 1] + 1) for m in WORD.finditer("".join(chars))]


def _spans(automaton: Automaton, tokens: list[str], max_words: int) -> list[tuple[int, int]]:
    """(first word, word after the last) of the places inside matches of at least ``max_words`` words, in order and apart."""
    out: list[tuple[int, int]] = []
    for i, n, _ in automaton.stream(tokens):
        if n >= max_words:
            a = i - n + 1
            while out and out[-1][1] >= a:
                a = min(a, out.pop()[0])
            out.append((a, i + 1))
    return out


def _cut(text: str | None, spans: list[tuple[int, int]], max_coverage: float) -> tuple[str | None, int, float]:
    """(text, removed words, coverage) with the words of ``spans`` taken out; nothing is left beyond ``max_coverage``."""
    if not spans or not text:
        return text, 0, 0.0
    aligned = _aligned(text)
    inside = bytearray(len(aligned))
    for a, b in spans:
        inside[a:b] = b"\x01" * (b - a)
    removed = sum(inside)
    share = removed / len(aligned)
    if share > max_coverage:
        return "", removed, share
    keep, last, j = [], 0, 0
    while j < len(aligned):
        if inside[j]:
            keep.append(text[last : aligned[j][1]])
            while j + 1 < len(aligned) and inside[j + 1]:
                j += 1
            last = aligned[j][2]
        j += 1
    return "".join([*keep, text[last:]]), removed, share


def without_leaks(documents: DataFrame, items: DataFrame, min_words: int = MIN_WORDS, max_words: int = MIN_WORDS, max_coverage: float = 0.5, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Every document with its leaked spans removed.

    Spans of at least ``max_words`` matching words are cut out.  A document whose
    share of such words exceeds ``max_coverage`` is emptied.  Several blocks of items
    first give the spans of each text, which then are cut at once, so the blocks
    don't show in the result.  Columns: doc_id, text, removed_words, coverage.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = item_blocks(items, block_chars)
    n, first = next(blocks)
    cut_schema, names = "doc_id long, text string, removed_words long, coverage double", ["doc_id", "text", "removed_words", "coverage"]

    def cut_batch(ids: pa.Array, texts: list[str | None], spans: list[list[tuple[int, int]]]) -> pa.RecordBatch:
        done = [_cut(t, s, max_coverage) for t, s in zip(texts, spans, strict=True)]
        return pa.RecordBatch.from_arrays([ids, *(pa.array([d[k] for d in done], t) for k, t in enumerate((pa.string(), pa.int64(), pa.float64())))], names=names)

    if n == 1:
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, first))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            a = _automaton(shared, min_words)
            for batch in batches:
                texts = batch.column(1).to_pylist()
                yield cut_batch(batch.column(0), texts, [_spans(a, words(t or ""), max_words) for t in texts])

        return docs.mapInArrow(run, cut_schema)

    found = None
    keyed = docs.withColumn("key", F.md5("text"))
    for _, block in itertools.chain([(n, first)], blocks):
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, block))

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            a = _automaton(shared, min_words)
            for batch in batches:
                ids, keys, froms, tos = [], [], [], []
                for doc, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                    for x, y in _spans(a, words(text.as_py() or ""), max_words):
                        ids.append(doc)
                        keys.append(key)
                        froms.append(x)
                        tos.append(y)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.string()), pa.array(froms, pa.int64()), pa.array(tos, pa.int64())], names=["doc_id", "key", "a", "b"])

        part = keyed.select("doc_id", "key", "text").mapInArrow(find, "doc_id long, key string, a long, b long")
        found = part if found is None else found.unionByName(part)
    # under the document's id as well, so that a text that very many documents hold loads no task
    spans = found.groupBy("doc_id", "key").agg(F.collect_set(F.struct("a", "b")).alias("spans"))  # no more than the words of one text

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield cut_batch(batch.column(0), batch.column(1).to_pylist(), [[(s["a"], s["b"]) for s in x or []] for x in batch.column(2).to_pylist()])

    return keyed.join(spans, ["doc_id", "key"], "left").select("doc_id", "text", "spans").mapInArrow(cut, cut_schema)
