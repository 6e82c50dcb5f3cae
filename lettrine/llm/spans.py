"""Long spans that occur verbatim in more than one document.

Seed and extend.  Whole copies collapse to one text first.  Each text is winnowed:
of every ``WINDOW`` consecutive windows of ``SEED`` characters the one with the
least fingerprint is an anchor, so any shared span of ``SEED + WINDOW - 1`` = 400
characters holds an anchor that both texts chose.  Texts meet on anchors that recur
and only there; from an anchor a match is extended both ways.  Extending by
``WINDOW - 1`` characters each way is enough: within a shared span the next anchor
lies no further, so matches of neighbouring anchors on one diagonal join up to the
maximal repeat.

An anchor that recurs in many texts is not joined with itself pair by pair.  There
each of the windows of 400 characters around the anchor becomes a key, and the texts
under one key share it; a short boilerplate that a third of all texts hold thus
makes no pairs unless 400 characters agree.

Spans are told without pairs: all windows of 400 characters that are equal form a
class, and successive windows whose classes hold the same texts in step form one span,
which is named by its first place.  A window's class follows from the one anchor that
its winnowing picks, so each window is looked at under a single anchor: the few texts
of a rare anchor in one small group, those of a frequent one by the window's key.

Defined results: null texts and texts under the least length share nothing;
positions count code points; repeated rows count once by ``doc_id``; extra columns
are ignored.  A span repeated within a single text is not shared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettrine.llm.base import persisted

LEAST = 400
SEED = 300
WINDOW = LEAST - SEED + 1
REACH = LEAST - SEED
#: Anchors in more texts than this are resolved by windows, the others by pairs; both ways are exact.
MANY = 48
#: Characters hashed at a time.
CHUNK = 1 << 19

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = _U(0xD6E8FEB86659FD93)
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = 1 << max(12, n.bit_length())
        steps = np.full(size, base, dtype=_U)
        steps[0] = 1
        _powers[name] = have = np.multiply.accumulate(steps)
    return have[:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _MIX
    return x ^ (x >> _U(29))


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def fingerprints(chars: np.ndarray, k: int) -> np.ndarray:
    """Of each window of ``k`` characters; equal windows have equal fingerprints wherever they stand."""
    n = len(chars)
    sums = np.zeros(n + 1, dtype=_U)
    np.cumsum(_mixed(chars.astype(_U) + _U(1)) * _power("up", _BASE, n), out=sums[1:])
    return _mixed((sums[k:] - sums[:-k]) * _power("down", _INVERSE, n - k + 1))


def _picked(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the leftmost least of each ``width`` neighbours."""
    at = np.arange(len(values), dtype=np.int64)
    best = values
    have = 1
    while have < width:
        step = min(have, width - have)
        left, right = best[:-step], best[step:]
        take = right < left
        at = np.where(take, at[step:], at[:-step])
        best = np.where(take, right, left)
        have += step
    return at


def anchors(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the text, place, fingerprint) of the anchors of texts, each at least ``LEAST`` long."""
    each = [codes(t) for t in texts]
    lengths = np.array([len(c) for c in each])
    starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    owner = np.repeat(np.arange(len(each)), lengths)
    prints = fingerprints(np.concatenate(each), SEED)
    whole = owner[: len(prints)] == owner[SEED - 1 :]
    prints = np.where(whole, prints, _U(0xFFFFFFFFFFFFFFFF))
    at = np.unique(_picked(prints, WINDOW))
    at = at[whole[at]]
    return owner[at], at - starts[owner[at]], prints[at].view(np.int64)


def _chunks(ids: list[int], texts: pa.Array) -> Iterator[tuple[list[int], list[str]]]:
    held, chunk, size = [], [], 0
    for i, t in zip(ids, texts, strict=True):
        t = t.as_py()
        held.append(i)
        chunk.append(t)
        size += len(t)
        if size >= CHUNK:
            yield held, chunk
            held, chunk, size = [], [], 0
    if chunk:
        yield held, chunk


def _anchor_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, texts in _chunks(batch.column(0).to_pylist(), batch.column(1)):
            who, at, prints = anchors(texts)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(ids, dtype=np.int64)[who]), pa.array(at.astype(np.int32)), pa.array(prints)], names=["rep", "at", "print"])


def classes(documents: DataFrame) -> DataFrame:
    """(doc_id, rep): the class of whole copies of each document of at least the least length, named by its smallest id."""
    d = documents.where(F.length("text") >= LEAST).select(F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("key"))
    reps = d.groupBy("key").agg(F.min("doc_id").alias("rep"))
    return d.join(reps, "key").select("doc_id", "rep").distinct()


def _with_context(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each recurring anchor with the text before, at and after it."""
    for batch in batches:
        cols: list[list] = [[] for _ in range(7)]
        for rep, text, found in zip(batch.column("rep").to_pylist(), batch.column("text"), batch.column("found"), strict=True):
            text = text.as_py()
            for a in found:
                at = a["at"].as_py()
                row = (rep, at, a["print"].as_py(), a["texts"].as_py(), text[max(0, at - REACH) : at], text[at : at + SEED], text[at + SEED : at + SEED + REACH])
                for c, x in zip(cols, row, strict=True):
                    c.append(x)
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["rep", "at", "print", "texts", "before", "seed", "after"])


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo = 0
    while lo < n and a[lo] == b[lo]:
        lo += 1
    return lo


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each seed pair the match around its anchor. Seeds are equal, which also rules out equal prints of different texts."""
    for batch in batches:
        c = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        out: list[list[int]] = [[] for _ in range(5)]
        for i in range(batch.num_rows):
            left = _common(c["before"][i][::-1], c["before_b"][i][::-1])
            right = _common(c["after"][i], c["after_b"][i])
            row = (c["rep"][i], c["rep_b"][i], c["at"][i] - left, c["at_b"][i] - left, left + SEED + right)
            for o, x in zip(out, row, strict=True):
                o.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], names=["rep_a", "rep_b", "start_a", "start_b", "chars"])


def _windowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of the least length around each anchor, by the MD5 of their text."""
    import hashlib

    for batch in batches:
        out: list[list] = [[], [], []]
        for rep, at, before, seed, after in zip(*(batch.column(n).to_pylist() for n in ("rep", "at", "before", "seed", "after")), strict=True):
            text = before + seed + after
            for i in range(len(text) - LEAST + 1):
                out[0].append(rep)
                out[1].append(at - len(before) + i)
                out[2].append(hashlib.md5(text[i : i + LEAST].encode("utf-8", "surrogatepass")).digest())
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], names=["rep", "start", "window"])


def owned(contexts: list[tuple[int, str]]) -> list[tuple[int, int]]:
    """For each (place of an anchor, text around it) the windows of the least length that pick this anchor: (first, last); last < first if none."""
    each = [codes(t) for _, t in contexts]
    lengths = np.array([len(c) for c in each])
    starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    owner = np.repeat(np.arange(len(each)), lengths)
    prints = fingerprints(np.concatenate(each), SEED)
    picked = _picked(prints, WINDOW)
    whole = owner[: len(picked)] == owner[LEAST - 1 : LEAST - 1 + len(picked)]
    place = starts + np.array([at for at, _ in contexts])
    mine = np.flatnonzero(whole & (picked == place[owner[: len(picked)]]))
    first, last = np.zeros(len(each), dtype=np.int64), np.full(len(each), -1, dtype=np.int64)
    who = owner[mine]
    last[who] = mine - starts[who]
    first[who[::-1]] = (mine - starts[who])[::-1]
    return list(zip(first.tolist(), last.tolist(), strict=True))


def _class_runs(occurrences: list[tuple[int, int, int, str]]) -> Iterator[tuple[int, int, int, int, int]]:
    """(rep, start, windows, first rep, first start) for each place in a run of equal windows around one anchor.

    An occurrence is (rep, place of the anchor in its text, place in the context, context).
    """
    ranges = owned([(at, text) for _, _, at, text in occurrences])
    open_runs: dict[tuple[int, ...], tuple[int, int]] = {}

    def told(members: tuple[int, ...], since: int, n: int) -> Iterator[tuple[int, int, int, int, int]]:
        places = [(occurrences[k][0], occurrences[k][1] + since) for k in members]
        first = min(places)
        for rep, start in places:
            yield rep, start, n, *first

    for o in range(-REACH, 1):
        alike: dict[str, list[int]] = {}
        for k, ((_, _, at, text), (lo, hi)) in enumerate(zip(occurrences, ranges, strict=True)):
            if lo <= at + o <= hi:
                alike.setdefault(text[at + o : at + o + LEAST], []).append(k)
        now = {}
        for m in alike.values():
            if len({occurrences[k][0] for k in m}) > 1:
                members = tuple(m)
                since, n = open_runs.pop(members, (o, 0))
                now[members] = (since, n + 1)
        for members, (since, n) in open_runs.items():
            yield from told(members, since, n)
        open_runs = now
    for members, (since, n) in open_runs.items():
        yield from told(members, since, n)


RUNS = "rep long, start long, windows long, first_rep long, first_start long"


def _runs_of_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for group in batch.column(0).to_pylist():
            by_seed: dict[str, list[tuple[int, int, int, str]]] = {}
            for g in group:
                by_seed.setdefault(g["seed"], []).append((g["rep"], g["at"], len(g["before"]), g["before"] + g["seed"] + g["after"]))
            for same in by_seed.values():
                if len(same) > 1:
                    rows.extend(_class_runs(same))
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["rep", "start", "windows", "first_rep", "first_start"])


def _owned_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows that pick each anchor, by the MD5 of their text."""
    import hashlib

    for batch in batches:
        out: list[list] = [[], [], []]
        rows = list(zip(*(batch.column(n).to_pylist() for n in ("rep", "at", "before", "seed", "after")), strict=True))
        for (rep, at, before, seed, after), (lo, hi) in zip(rows, owned([(len(r[2]), r[2] + r[3] + r[4]) for r in rows]) if rows else [], strict=True):
            text = before + seed + after
            for i in range(lo, hi + 1):
                out[0].append(rep)
                out[1].append(at - len(before) + i)
                out[2].append(hashlib.md5(text[i : i + LEAST].encode("utf-8", "surrogatepass")).digest())
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], names=["rep", "start", "window"])


class SharedSpans:
    """The shared spans of documents, computed once and read in several ways."""

    def __init__(self, documents: DataFrame):
        docs = documents.where(F.length("text") >= LEAST).select(F.col("doc_id").cast("long").alias("rep"), "text")
        self.members = persisted(classes(documents), "copies")
        reps = self.members.where("doc_id = rep").select("rep")
        texts = docs.join(reps, "rep", "left_semi").dropDuplicates(["rep"])
        found = persisted(docs.mapInArrow(_anchor_batches, "rep long, at int, print long").join(reps, "rep", "left_semi"), "anchors")
        recurring = found.groupBy("print").agg(F.count("*").alias("texts"), F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo <> hi").select("print", "texts")
        kept = found.join(recurring, "print").groupBy("rep").agg(F.collect_list(F.struct("at", "print", "texts")).alias("found"))
        context = "rep long, at int, print long, texts long, before string, seed string, after string"
        self.seeds = persisted(texts.join(kept, "rep").select("rep", "text", "found").mapInArrow(_with_context, context), "seeds")

    def matches(self) -> DataFrame:
        """Matches around anchors in few texts: (rep_a, rep_b, start_a, start_b, chars)."""
        few = self.seeds.where(F.col("texts") <= MANY)
        b = few.select("print", "seed", F.col("rep").alias("rep_b"), F.col("at").alias("at_b"), F.col("before").alias("before_b"), F.col("after").alias("after_b"))
        pairs = few.join(b, ["print", "seed"]).where("rep < rep_b").drop("print", "seed", "texts")
        return pairs.mapInArrow(_extended, "rep_a long, rep_b long, start_a long, start_b long, chars long")

    def windows(self) -> DataFrame:
        """Windows around anchors in many texts: (window, rep, start)."""
        return self.seeds.where(F.col("texts") > MANY).mapInArrow(_windowed, "rep long, start long, window binary").dropDuplicates(["window", "rep", "start"])

    def maximal(self) -> DataFrame:
        """The places of the maximal shared spans: (span_rep, span_start, rep, start, chars, texts).

        One row for each place of each span; a span is named by its first place, and
        ``texts`` counts the different texts that hold it.  Two texts share exactly the
        spans that both have.  No pairs are made.
        """
        from pyspark.sql import Window as W

        few = self.seeds.where(F.col("texts") <= MANY).groupBy("print").agg(F.collect_list(F.struct("rep", "at", "before", "seed", "after")).alias("group"))  # at most MANY
        runs = few.select("group").mapInArrow(_runs_of_groups, RUNS)
        w = persisted(self.seeds.where(F.col("texts") > MANY).mapInArrow(_owned_windows, "rep long, start long, window binary"), "windows")
        firsts = w.groupBy("window").agg(F.min(F.struct("rep", "start")).alias("first"), F.max("rep").alias("hi")).where("first.rep <> hi")
        hot = w.join(firsts, "window").select("rep", "start", F.lit(1).cast("long").alias("windows"), F.col("first.rep").alias("first_rep"), F.col("first.start").alias("first_start"))
        runs = persisted(runs.unionByName(hot), "span-runs")
        # what a class holds, in step with its first place
        step = F.xxhash64("rep", F.col("start") - F.col("first_start"))
        held = runs.groupBy("first_rep", "first_start").agg(F.bit_xor(step).alias("held"), F.countDistinct("rep").alias("texts"))
        line = W.partitionBy("rep", "first_rep", "held", "texts", "ahead").orderBy("start")
        r = runs.join(held, ["first_rep", "first_start"]).withColumn("ahead", F.col("start") - F.col("first_start"))
        r = r.withColumn("fresh", F.coalesce(F.lag(F.col("start") + F.col("windows")).over(line) != F.col("start"), F.lit(True)).cast("int")).withColumn("run", F.sum("fresh").over(line))
        out = r.groupBy("rep", "first_rep", "held", "texts", "ahead", "run").agg(F.min("start").alias("start"), F.min("first_start").alias("span_start"), F.sum("windows").alias("n"))
        return out.select(F.col("first_rep").alias("span_rep"), "span_start", "rep", "start", (F.col("n") + LEAST - 1).alias("chars"), "texts")

    def text_pairs(self) -> DataFrame:
        """Pairs of different texts that share a span: (rep_a, rep_b)."""
        few = self.matches().where(F.col("chars") >= LEAST).select("rep_a", "rep_b")
        w = self.windows().select("window", "rep").distinct()
        many = w.join(w.withColumnRenamed("rep", "rep_b"), "window").where("rep < rep_b").select(F.col("rep").alias("rep_a"), "rep_b")
        return few.unionByName(many).distinct()

    def document_pairs(self) -> DataFrame:
        """Pairs of documents, copies included: (doc_id_a, doc_id_b), a < b."""
        m = self.members
        n = m.groupBy("rep").agg(F.count("*").alias("n")).where("n > 1").select("rep")
        copied = m.join(n, "rep", "left_semi")
        within = copied.select("rep", F.col("doc_id").alias("x")).join(copied.select("rep", F.col("doc_id").alias("y")), "rep").where("x < y").select("x", "y")
        across = self.text_pairs().join(m.select(F.col("rep").alias("rep_a"), F.col("doc_id").alias("x")), "rep_a").join(m.select(F.col("rep").alias("rep_b"), F.col("doc_id").alias("y")), "rep_b").select("x", "y")
        both = within.unionByName(across)
        return both.select(F.least("x", "y").alias("doc_id_a"), F.greatest("x", "y").alias("doc_id_b"))

    def shared_chars(self, documents: DataFrame) -> DataFrame:
        """Of every document: n_chars, shared_chars (in spans that another document holds too) and shared_share.

        No pairs are made for copies or for hot windows; a text's own intervals suffice.
        """
        from pyspark.sql import Window as W

        m = self.matches().where(F.col("chars") >= LEAST)
        w = self.windows()
        hot = w.groupBy("window").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo <> hi").select("window")
        spans = (
            m.select(F.col("rep_a").alias("rep"), F.col("start_a").alias("start"), "chars")
            .unionByName(m.select(F.col("rep_b").alias("rep"), F.col("start_b").alias("start"), "chars"))
            .unionByName(w.join(hot, "window", "left_semi").select("rep", "start", F.lit(LEAST).cast("long").alias("chars")))
            .distinct()
        )
        end = F.col("start") + F.col("chars")
        before = F.max(end).over(W.partitionBy("rep").orderBy("start", "chars").rowsBetween(W.unboundedPreceding, -1))
        fresh = F.greatest(F.lit(0), end - F.greatest(F.col("start"), F.coalesce(before, F.lit(0))))
        sums = spans.withColumn("fresh", fresh).groupBy("rep").agg(F.sum("fresh").alias("partly"))
        sizes = self.members.groupBy("rep").agg(F.count("*").alias("copies"))
        known = self.members.join(sizes, "rep").join(sums, "rep", "left").select("doc_id", "copies", "partly")
        n_chars = F.coalesce(F.length("text"), F.lit(0)).cast("long")
        docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), n_chars.alias("n_chars")).distinct()
        shared = F.when(F.col("copies") > 1, F.col("n_chars")).otherwise(F.coalesce("partly", F.lit(0)))
        out = docs.join(known, "doc_id", "left").withColumn("shared_chars", shared)
        return out.select("doc_id", "n_chars", "shared_chars", F.when(F.col("n_chars") > 0, F.col("shared_chars") / F.col("n_chars")).otherwise(0.0).alias("shared_share"))
