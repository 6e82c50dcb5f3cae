"""Text garbled by a wrong character encoding: found, and restored where it can be.

Character n-gram models (orders 1 to 3, smoothed by interpolation) are trained on
clean values.  For a value with characters beyond ASCII every chain of encoding and
decoding that fits is undone; the likeliest candidate is accepted if its
log-likelihood exceeds that of the value as it stands by a margin.  The margin is
validated on all clean values and on the same values garbled on purpose: each task
counts their gains in a grid, the sums of the grids decide.

Training takes several passes over all values: the first leaves out what decodes as
UTF-8 after re-encoding, each later one what the model before would change.  Counts
live in hashed tables of fixed size, so the broadcast model never grows with the
data.  Verdicts depend on the characters beyond ASCII and their neighbours only;
equal surroundings are judged once in each worker.

Defined results: null, empty and pure ASCII values are never garbled; values with
U+FFFD are garbled but can only partly be restored, so they are reported with a
null restoration; equal values get equal answers wherever they occur; values of
any length are read whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettrine.llm.base import persisted

#: Encodings in which bytes may wrongly have been read, and those in which they were meant.
WRONG = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1251", "cp1250", "iso8859-15", "cp1253", "koi8-r")
MEANT = ("utf-8", "cp1252", "mac_roman", "cp850", "cp437")
#: Steps of wrong decoding that are undone, one after the other.
STEPS = 3
LOST = "�"
SIZE = 1 << 18
#: Passes that clean the training values, and the log-odds from which such a pass leaves a value out.
ROUNDS = 3
CLEANING = 2.0
#: ASCII characters kept on either side of others when a value is judged.
NEAR = 2
#: Margins among which the validation chooses.
GRID = np.arange(0.5, 15.1, 0.5)

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_SHIFT = np.uint64(64 - 18)
START = 2
_WORDS = re.compile("([ \x04]+)")


@lru_cache(1)
def _tables() -> dict[str, dict[str, int]]:
    """Characters to bytes for each single-byte encoding; bytes that it leaves undefined stand for control characters."""
    out = {}
    for name in {*WRONG, *MEANT} - {"utf-8"}:
        table = {}
        for b in range(256):
            try:
                ch = bytes([b]).decode(name)
            except UnicodeDecodeError:
                ch = chr(b)
            table.setdefault(ch, b)
        out[name] = table
    return out


@lru_cache(1)
def _decoders() -> dict[str, list[str]]:
    return {name: [next(c for c, b in t.items() if b == i) if i in t.values() else chr(i) for i in range(256)] for name, t in _tables().items()}


def to_bytes(text: str, encoding: str) -> bytes | None:
    table = _tables()[encoding]
    try:
        return bytes([table[ch] for ch in text])
    except KeyError:
        return None


def from_bytes(data: bytes, encoding: str) -> str | None:
    if encoding == "utf-8":
        try:
            return data.decode("utf-8")
        except UnicodeDecodeError:
            return None
    return "".join(map(_decoders()[encoding].__getitem__, data))


def _step(text: str, wrong: str, meant: str) -> str | None:
    """One step undone: in the whole text, or else in those of its words where it fits."""
    data = to_bytes(text, wrong)
    whole = None if data is None else from_bytes(data, meant)
    if whole is not None:
        return whole if whole != text else None
    parts = _WORDS.split(text)
    for k, part in enumerate(parts):
        if not part.isascii() and (data := to_bytes(part, wrong)) is not None:
            parts[k] = from_bytes(data, meant) or part
    out = "".join(parts)
    return out if out != text else None


def undone_once(text: str, meanings: tuple[str, ...] = MEANT) -> Iterator[tuple[str, str]]:
    """(candidate, chain) for each single step that fits."""
    parts = None
    for wrong in WRONG:
        data = to_bytes(text, wrong)
        some = None
        for meant in meanings:
            if meant == wrong:
                continue
            candidate = None if data is None else from_bytes(data, meant)
            if candidate is None:
                if some is None:
                    parts = parts or _WORDS.split(text)
                    some = [None if p.isascii() else to_bytes(p, wrong) for p in parts]
                if not any(some):
                    continue
                candidate = "".join(p if b is None else from_bytes(b, meant) or p for p, b in zip(parts, some, strict=True))
            if candidate != text:
                yield candidate, f"{wrong}>{meant}"


def _softened(text: str) -> list[str]:
    """The text, and as it was before a no-break space after a lead byte turned into a blank."""
    soft = text
    for lead in ("Ã", "Â", "├", "√", "Г"):
        soft = soft.replace(lead + " ", lead + "\xa0")
        if soft.endswith(lead):
            soft += "\xa0"
    return [text] if soft == text else [text, soft]


def undone(text: str) -> dict[str, str]:
    """Candidates of up to ``STEPS`` steps with their chains; a further step only after one that gave UTF-8, and to UTF-8."""
    out: dict[str, str] = {}
    last = [(base, "") for base in _softened(text)]
    for step in range(STEPS):
        found = []
        for now, before in last:
            for candidate, chain in undone_once(now, ("utf-8",) if step else MEANT):
                whole = f"{before},{chain}" if before else chain
                if candidate not in out:
                    out[candidate] = whole
                    if chain.endswith("utf-8") and not candidate.isascii():
                        found.append((candidate, whole))
        last = found
    out.pop(text, None)
    return out


def restored(text: str, chain: str) -> str | None:
    """The text with a chain undone."""
    for base in reversed(_softened(text)):
        now: str | None = base
        for step in chain.split(","):
            now = _step(now, *step.split(">"))
            if now is None:
                break
        if now is not None:
            return now
    return None


def surely_odd(text: str) -> bool:
    """Holds a lost or control character, or reads as UTF-8 once re-encoded."""
    if LOST in text or any("\x7f" <= c <= "\x9f" for c in text):
        return True
    if text.isascii():
        return False
    return any(True for base in _softened(text) for _ in undone_once(base, ("utf-8",)))


def _coded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all texts, each behind two start marks and before an end mark; the length of each."""
    texts = [t.lower() for t in texts]
    joined = "".join(f"\x02\x02{t}\x03" for t in texts)
    sizes = np.array([len(t) + 3 for t in texts])
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64), sizes


def _places(c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed places of the 1-, 2- and 3-grams that end at each character from the third on."""
    one = (c * _A) >> _SHIFT
    two = (c[1:] * _A + c[:-1] * _B) >> _SHIFT
    three = (c[2:] * _A + c[1:-1] * _B + c[:-2] * _C) >> _SHIFT
    return one[2:].astype(np.int64), two[1:].astype(np.int64), three.astype(np.int64)


def counts(texts: list[str]) -> np.ndarray:
    """A table of 3 rows: counts of the hashed n-grams of each order."""
    c, _ = _coded(texts)
    table = np.zeros((3, SIZE), dtype=np.int64)
    if len(c) > 2:
        real = c[2:] != START
        for k, p in enumerate(_places(c)):
            table[k] += np.bincount(p[real], minlength=SIZE)
    return table


_PLAIN = re.compile(r"([ -~]{%d})[ -~]+?(?=[ -~]{%d}(?:[^ -~]|\Z))" % (NEAR, NEAR))
_ENDS = re.compile(r"\A[ -~]+(?=[ -~]{%d}[^ -~])|(?<=[^ -~])([ -~]{%d})[ -~]+\Z" % (NEAR, NEAR))


def surroundings(text: str) -> str:
    """The characters beyond ASCII with ``NEAR`` neighbours on either side; what is left out becomes a gap."""
    text = _ENDS.sub(lambda m: (m[1] or "") + "\x04", text)
    return _PLAIN.sub("\\1\x04", text)


class Model:
    """Interpolated log-probabilities of the characters beyond ASCII, given the two before and given the two after.

    ASCII characters are context only: every chain leaves them as they are, and what
    follows a rare character is always likely, which says nothing about the character.
    """

    def __init__(self, table: np.ndarray, margin: float = 0.0):
        self.table = table.astype(np.float32)
        self.total = float(table[0].sum()) or 1.0
        self.margin = margin
        self.known: dict[str, tuple] = {}

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        c, sizes = _coded(texts)
        c = np.concatenate((c, np.array([START, START], dtype=np.uint64)))
        t, n = self.table, len(c) - 2
        two_all = ((c[1:] * _A + c[:-1] * _B) >> _SHIFT).astype(np.int64)
        one_all = ((c * _A) >> _SHIFT).astype(np.int64)
        three_all = ((c[2:] * _A + c[1:-1] * _B + c[:-2] * _C) >> _SHIFT).astype(np.int64)
        at = np.flatnonzero(c[2:n] > 126) + 2
        p1 = (t[0][one_all[at]] + 0.02) / (self.total + 1000)

        def back_off(pair: np.ndarray, single: np.ndarray, triple: np.ndarray, double: np.ndarray) -> np.ndarray:
            n2, n3 = t[1][pair], t[2][triple]
            p2 = (n2 + 3 * p1) / (np.maximum(t[0][single], n2) + 3)
            return np.log((n3 + 3 * p2) / (np.maximum(t[1][double], n3) + 3))

        logs = np.zeros(n)
        logs[at] = back_off(two_all[at - 1], one_all[at - 1], three_all[at - 2], two_all[at - 2]) + back_off(two_all[at], one_all[at + 1], three_all[at], two_all[at + 1])
        sums = np.concatenate(([0.0], np.cumsum(logs)))
        ends = np.cumsum(sizes)
        return sums[ends] - sums[ends - sizes]

    def judged(self, texts: list[str]) -> list[tuple[bool, str | None, str | None, float]]:
        """(garbled, restored, chain, gain) of each text."""
        around = [None if t.isascii() else surroundings(t) for t in texts]
        new = list({a for a in around if a is not None and a not in self.known})
        if len(self.known) + len(new) > 500_000:
            self.known = {}
            new = list({a for a in around if a is not None})
        for i in range(0, len(new), 2000):
            self._judge(new[i : i + 2000])
        out = []
        for t, a in zip(texts, around, strict=True):
            if a is None:
                out.append((False, None, None, 0.0))
                continue
            bad, chain, gain = self.known[a]
            out.append((bad, restored(t, chain) if chain else None, chain, gain))
        return out

    def _judge(self, texts: list[str]) -> None:
        asked, owner, chains = list(texts), [], []
        for i, t in enumerate(texts):
            for candidate, chain in undone(t).items():
                asked.append(candidate)
                owner.append(i)
                chains.append(chain)
        s = self.scores(asked)
        best: dict[int, tuple[float, int]] = {}
        for k, i in enumerate(owner):
            gain = float(s[len(texts) + k] - s[i])
            if i not in best or gain > best[i][0]:
                best[i] = (gain, k)
        for i, t in enumerate(texts):
            gain, k = best.get(i, (0.0, -1))
            if k >= 0 and gain > self.margin and LOST not in t:
                self.known[t] = True, chains[k], gain
            else:
                self.known[t] = LOST in t or any("\x7f" <= ch <= "\x9f" for ch in t), None, gain


def _trained(values: DataFrame, keep, tables: int = 1) -> np.ndarray:
    """Counts over all values: ``keep`` sorts the texts of a batch into as many lists as there are tables.

    Each task sends its tables, of fixed size; their sum is ``tables`` x 3 x SIZE rows at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((tables, 3, SIZE), dtype=np.int64)
        for batch in batches:
            for k, texts in enumerate(keep([t for t in batch.column(0).to_pylist() if t])):
                for i in range(0, len(texts), 20_000):
                    table[k] += counts(texts[i : i + 20_000])
        flat = table.reshape(-1)
        place = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array(flat[place])], names=["place", "n"])

    sums = values.mapInArrow(run, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(tables * 3 * SIZE, dtype=np.int64)
    table[sums["place"].to_numpy()] = sums["n"].to_numpy()
    return table.reshape(tables, 3, SIZE)


def _garbled_on_purpose(text: str) -> Iterator[str]:
    for meant in ("utf-8", "cp1252"):
        try:
            data = text.encode(meant)
        except UnicodeEncodeError:
            continue
        for wrong in ("cp1252", "mac_roman", "cp850", "cp437", "cp1251"):
            if wrong != meant:
                bad = from_bytes(data, wrong)
                if bad is not None and bad != text:
                    yield bad


def gain_counts(model: Model, clean: dict[str, int]) -> np.ndarray:
    """Two rows of counts: gains of clean surroundings, and of the same garbled on purpose, by how many margins they exceed."""
    out = np.zeros((2, len(GRID) + 1), dtype=np.int64)
    bad = [(b, n) for t, n in clean.items() for b in _garbled_on_purpose(t)]
    for k, asked in enumerate((list(clean.items()), bad)):
        for i in range(0, len(asked), 20_000):
            part = asked[i : i + 20_000]
            gains = np.array([g for *_, g in model.judged([t for t, _ in part])])
            np.add.at(out[k], np.searchsorted(GRID, gains, side="left"), [n for _, n in part])
    return out


def margin_of(gains: np.ndarray) -> float:
    """The margin with the least error, clean values counting thirty times as often as garbled ones."""
    good, bad = gains
    if not good.sum():
        return 5.0
    above = lambda row: row.sum() - np.cumsum(row)[:-1]  # noqa: E731 - values whose gain exceeds each margin
    loss = 30 * above(good) / good.sum() + (1 - above(bad) / bad.sum() if bad.sum() else 0)
    best = GRID[loss <= loss.min() + 1e-9]
    return float((best[0] + best[-1]) / 2)


def validated_margin(values: DataFrame, model: Model) -> float:
    """The margin by all values of the single string column that ``model``, with its own margin, finds clean."""
    shared = values.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, len(GRID) + 1), dtype=np.int64)
        clean: Counter = Counter()

        def counted() -> None:
            total[:] += gain_counts(shared.value, clean)
            clean.clear()

        for batch in batches:
            texts = [t for t in batch.column(0).to_pylist() if t and not t.isascii()]
            # verdicts depend on the surroundings only
            clean.update(surroundings(t) for t, (bad, *_) in zip(texts, shared.value.judged(texts), strict=True) if not bad)
            if len(clean) > 100_000:
                counted()
        counted()
        kinds, bins = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(kinds.astype(np.int32)), pa.array(bins.astype(np.int32)), pa.array(total[kinds, bins])], names=["kind", "bin", "n"])

    gains = np.zeros((2, len(GRID) + 1), dtype=np.int64)
    for r in values.mapInArrow(run, "kind int, bin int, n long").groupBy("kind", "bin").agg(F.sum("n").alias("n")).collect():  # two grids
        gains[r["kind"], r["bin"]] = r["n"]
    return margin_of(gains)


def train(values: DataFrame) -> Model:
    """The model of the clean values in the single string column of ``values``."""
    column = values.columns[0]
    plain = F.col(column).rlike(r"^[\x00-\x7f]*$")
    others = values.where(~plain)
    ascii_table, table = _trained(values, lambda texts: ([t for t in texts if t.isascii()], [t for t in texts if not t.isascii() and not surely_odd(t)]), 2)
    for _ in range(ROUNDS):
        shared = values.sparkSession.sparkContext.broadcast(Model(ascii_table + table, CLEANING))

        def clean(texts: list[str], shared=shared) -> tuple[list[str]]:
            return ([t for t, (bad, *_) in zip(texts, shared.value.judged(texts), strict=True) if not bad],)

        table = _trained(others, clean)[0]
    margin = validated_margin(others, Model(ascii_table + table, CLEANING))
    return Model(ascii_table + table, margin)


def fields(emails: DataFrame) -> DataFrame:
    """(record_id, field_path, value) of the subject, the contacts' names and the attachments' names."""

    def each(column: str, name: str):
        return F.transform(F.coalesce(F.col(column), F.array()), lambda x, i: F.struct(F.concat(F.lit(f"{column}["), i.cast("string"), F.lit(f"].{name}")).alias("field_path"), x[name].alias("value")))

    def one(path: str):
        return F.array(F.struct(F.lit(path).alias("field_path"), F.col(path).alias("value")))

    all_of = F.concat(one("subject"), one("author.name"), each("targets", "name"), each("cc", "name"), each("bcc", "name"), each("attachments", "original_name"))
    return emails.select(F.col("record_id").cast("long").alias("record_id"), F.explode(all_of).alias("f")).select("record_id", "f.field_path", "f.value").where("value is not null")


def judge(emails: DataFrame) -> DataFrame:
    """(record_id, field_path, value, restored, chain, gain) of the garbled values.

    The model is trained on distinct values; then every field is judged where it
    stands, so a value that fills very many rows moves nowhere.
    """
    told = fields(emails)
    model = emails.sparkSession.sparkContext.broadcast(train(persisted(told.select("value").distinct(), "values")))
    beyond = told.where(~F.col("value").rlike(r"^[\x00-\x7f]*$"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, paths, texts = (c.to_pylist() for c in batch.columns)
            found = [(i, p, t, r, c, g) for i, p, t, (bad, r, c, g) in zip(ids, paths, texts, model.value.judged(texts), strict=True) if bad]
            cols = list(zip(*found, strict=True)) if found else [[]] * 6
            types = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["record_id", "field_path", "value", "restored", "chain", "gain"])

    return beyond.mapInArrow(run, "record_id long, field_path string, value string, restored string, chain string, gain double")
