"""Linking the spellings under which one person or organisation appears.

A spelling is a distinct (name, address).  Word lists (mailbox names, words of firm
names, given names, nicknames) are learned from all spellings by counting the
organisations in which a word occurs.  Each spelling is read into a typed name
(surname, given name or initial; or the name of an organisation) and what its address
tells.  The addresses at organisations give the entities.

Names meet entities only in a metric space: all typed names are joined with all names
of entities within an edit distance.  Strings go to the cell of the nearest of some
pivots, strings near a boundary are replicated by the triangle inequality, cells that
hold too many are split again by pivots of their own, and inside a cell and ring the
edit distance decides.  Addresses then verify a meeting (the name met must be the one
that the address tells) or, where there is none, given names and initials decide among
all people that the name may mean.

Defined results: rows without name and address, and names that cannot be told
apart between several entities, are linked to nothing but the same spelling;
letter case, accents, titles and extra blanks don't matter; a row without a name
enters with the name that its address tells; repeated rows of one ``contact_id``
count once; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettrine.llm.base import folded, persisted

#: Titles before names.
TITLES = frozenset("m mr mrs ms miss mme mlle madame monsieur mademoiselle dr docteur doctor me maitre prof professeur professor sir".split())
#: Legal forms and words that only firms carry.
FIRM_WORDS = frozenset("sa sas sasu sarl sci snc eurl gmbh ag ltd limited inc llc plc ste societe groupe group cabinet company cie".split())
#: Labels before the name of an organisation in its domain.
SUBDOMAINS = frozenset("mail smtp www mx email".split())
#: A domain with more different local parts than this and without a mailbox of its own is a provider of private addresses.
PRIVATE_SURNAMES = 40


def damerau_is_one(a: str, b: str) -> bool:
    """One insertion, deletion, substitution or exchange of neighbours apart."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    x, y = a[i:], b[i:]
    return x[1:] == y or x == y[1:] or x[1:] == y[1:] or (x[:2] == y[1::-1] and x[2:] == y[2:])


@lru_cache(100_000)
def near(a: str, b: str) -> bool:
    return a == b or damerau_is_one(a, b)


def _shortened(word: str) -> set[str]:
    """The word and its forms with one letter left out; words one edit or swap apart share one."""
    return {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}


@dataclass
class Words:
    """What is learned from all spellings; every list is bounded by its threshold."""

    mailboxes: frozenset[str] = frozenset()
    private: frozenset[str] = frozenset()
    firm: frozenset[str] = frozenset()
    given: dict[str, int] = field(default_factory=dict)
    nick: dict[str, str] = field(default_factory=dict)
    #: Given names of more than three letters by each form of theirs with one letter left out.
    slips: dict[str, list[str]] = field(default_factory=dict)

    def index_given(self) -> None:
        self.slips = {}
        for g in self.given:
            if len(g) > 3:
                for x in _shortened(g):
                    self.slips.setdefault(x, []).append(g)


def split_address(address: str | None) -> tuple[str, str, str] | None:
    """(local part, domain, name of the organisation in the domain) in lower case."""
    if not address or address.count("@") != 1:
        return None
    local, domain = folded(address.strip(" <>\"'")).split("@")
    labels = domain.split(".")
    while len(labels) > 2 and labels[0] in SUBDOMAINS:
        labels = labels[1:]
    if not local or len(labels) < 2:
        return None
    return local, ".".join(labels), labels[-2].split("-")[0]


_PAREN = re.compile(r"\(([^)]*)\)")


def name_tokens(name: str | None) -> tuple[list[str], bool, str | None]:
    """(words of a name, whether a comma stands after the first part, what stands in brackets)."""
    text = name or ""
    m = _PAREN.search(text)
    text = _PAREN.sub(" ", text)
    if "@" in text:
        return [], False, None
    shown = text.strip(" \"'")
    if " " not in shown and "," not in shown and "." in shown.strip("."):
        shown = shown.replace(".", " ")
    comma = "," in shown
    words = [w for w in re.split(r"[\s,;\"]+", folded(shown)) if w.strip("-.'")]
    return words, comma, folded(m[1]).strip() if m else None


def bare(word: str) -> str:
    return word.replace(".", "").strip("-'")


def firm_token(word: str, w: Words) -> bool:
    return bare(word) in FIRM_WORDS or word in w.firm or bare(word) in w.firm


def given_of(token: str, w: Words) -> tuple[str | None, str | None]:
    """(full given name, initial) that a word tells."""
    t = bare(token)
    if t in w.nick:
        return w.nick[t], w.nick[t][0]
    if t in w.given:
        return t, t[0]
    if len(t) == 1 or re.fullmatch(r"[a-z]\.?-[a-z]\.?", token):
        return None, t[0]
    close = {g for x in _shortened(t) for g in w.slips.get(x, ()) if damerau_is_one(g, t)}
    if close:
        best = max(close, key=lambda g: (w.given[g], g))
        return best, best[0]
    return None, None


def read_local(local: str, tokens: list[str], w: Words) -> tuple[str, str | None, str | None]:
    """(surname, given name, initial) of the local part of a person's address."""
    parts = [p for p in re.split(r"[._]", local) if p]
    if len(parts) >= 2:
        a, b = parts[0], parts[-1]
        if len(a) == 1:
            return b, None, a
        if len(b) == 1:
            return a, None, b
        first, second = w.given.get(a, 0), w.given.get(b, 0)
        if first == second and tokens:
            first, second = (1, 0) if near(tokens[-1], b) else (0, 1) if near(tokens[-1], a) else (1, 0)
        return (b, a, a[0]) if first >= second else (a, b, b[0])
    rest = local[1:]
    if tokens and any(near(bare(t), local) for t in tokens) and not any(near(bare(t), rest) for t in tokens):
        return local, None, None
    return rest, None, local[:1]


def _typed(words: list[str], told: str) -> str:
    """The word of a typed name that stands for what the address tells; that itself where no word is typed."""
    if told in words or not words:
        return told
    return min(words, key=lambda x: (_edit(x, told), x))


def read_spelling(name: str | None, address: str | None, w: Words) -> tuple[str, str | None, str | None, str | None, str | None, str | None] | None:
    """(kind, organisation, surname, given name, initial, typed); kind is o(rganisation), p(erson) or n(ame without an organisation).

    ``surname`` and an organisation's name are those of the address where there is one, ``typed`` is how the name has it.
    """
    tokens, comma, inside = name_tokens(name)
    at = split_address(address)
    pieces = [p for t in tokens for p in ([t] if t in w.given or firm_token(t, w) else t.split("-"))]
    firm = [t for t in pieces if firm_token(t, w)]
    rest = [t for t in pieces if not firm_token(t, w) and len(bare(t)) > 1]
    private = at is not None and at[1] in w.private
    if at and not private and (at[0] in w.mailboxes or any(bare(t) == at[2] for t in pieces) and not any(near(bare(t), x) for t in rest if bare(t) != at[2] for x in re.split(r"[._]", at[0]) + [at[0][1:]])):
        return "o", at[2], None, None, None, _typed([bare(t) for t in rest], at[2])
    if not at and firm and rest:
        return "o", None, None, None, None, bare(max(rest, key=len))
    people = [t for t in tokens if bare(t)]
    while len(people) > 1 and bare(people[0]) in TITLES and (len(people) > 2 or len(bare(people[0])) > 1 or at):
        people = people[1:]
    org = at[2] if at and not private else inside.split()[0] if inside and inside.split() else None
    if at:
        surname, given, initial = read_local(at[0], people, w)
        if given is None:
            others = [t for t in people if not near(bare(t), surname)]
            if len(people) >= 2 and len(others) == len(people):  # a surname typed beyond one edit; the other word tells the given name
                others = [t for t in people if given_of(t, w)[0] or len(bare(t)) == 1]
            for t in others:
                g, i = given_of(t, w)
                if g and (initial is None or g[0] == initial):
                    given, initial = g, g[0]
                    break
                if initial is None and i:
                    initial = i
        shown = [bare(t) for t in people if len(bare(t)) > 1]
        return ("p" if org else "n"), org, surname, given, initial, _typed([t for t in shown if t not in w.given] or shown, surname)
    if not people:
        return None
    if len(people) == 1:
        return "n", org, bare(people[0]), None, None, None
    told = [(given_of(t, w), t) for t in people]
    scores = [(2 if bare(t) in w.given or bare(t) in w.nick else 1 if g or i else 0, w.given.get(g or "", 0)) for (g, i), t in told]
    k = len(people) - 1 if comma and scores[-1][0] else max(range(len(people)), key=lambda j: (scores[j], -j))
    surname = " ".join(bare(t) for j, t in enumerate(people) if j != k)
    (given, initial), word = told[k]
    if not initial and not given:
        given, initial = bare(word), bare(word)[0]
    return "n", org, surname, given, initial, None


def _pairs(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)


def _counted(spellings: DataFrame, emit, least: Column, extra: int = 1) -> list:
    """Words with the number of organisations they occur in, from ``least`` on: a list bounded by that threshold."""
    schema = "word string, other string, org string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r for n, a in zip(*(c.to_pylist() for c in batch.columns), strict=True) for r in emit(n, a)]
            yield _pairs(list(dict.fromkeys(rows)), ["word", "other", "org"], [pa.string()] * 3)

    found = spellings.select("name", "address").mapInArrow(run, schema)
    return found.groupBy("word", "other").agg(F.countDistinct("org").alias("orgs")).where(F.col("orgs") >= least).collect()


def learn(spellings: DataFrame) -> Words:
    """The word lists, from all spellings."""
    w = Words()

    def domains(name, address):
        at = split_address(address)
        return [(at[1], at[0], at[2])] if at else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r for n, a in zip(*(c.to_pylist() for c in batch.columns), strict=True) for r in domains(n, a)]
            yield _pairs(rows, ["domain", "local", "org"], [pa.string()] * 3)

    at = persisted(spellings.select("name", "address").mapInArrow(run, "domain string, local string, org string").distinct(), "addresses")
    n_orgs = at.agg(F.countDistinct("org")).first()[0] or 0
    share = lambda part, least: F.lit(max(least, part * n_orgs))
    boxes = at.where(~F.col("local").rlike(r"[._]")).groupBy("local").agg(F.countDistinct("org").alias("orgs")).where(F.col("orgs") >= share(0.01, 4)).collect()
    w.mailboxes = frozenset(r["local"] for r in boxes)
    boxed = F.col("local").isin(*w.mailboxes) if w.mailboxes else F.lit(False)
    # a provider serves far more people than one organisation: at least a thousandth of all organisations' number, too
    wide = at.groupBy("domain").agg(F.countDistinct("local").alias("n"), F.max(boxed.cast("int")).alias("boxed"))
    w.private = frozenset(r["domain"] for r in wide.where((F.col("n") > F.lit(max(PRIVATE_SURNAMES, 0.001 * n_orgs))) & (F.col("boxed") == 0)).collect())

    def shown(name, address):
        at = split_address(address)
        if not at:
            return []
        if at[0] in w.mailboxes:  # words beside the name of a firm
            return [(p, "firm", at[2]) for t in name_tokens(name)[0] for p in {t, *t.split("-")} if bare(p) and bare(p) != at[2]]
        local = [p for p in re.split(r"[._]", at[0]) if len(p) > 1] if re.search(r"[._]", at[0]) else []
        return [(p, "person", at[0] if at[1] in w.private else at[2]) for p in local]

    told = _counted(spellings, shown, share(0.0005, 3))
    w.firm = frozenset(r["word"] for r in told if r["other"] == "firm" and r["orgs"] >= max(3, 0.001 * n_orgs))
    w.given = {r["word"]: r["orgs"] for r in told if r["other"] == "person"}
    w.index_given()

    def nicks(name, address):
        at = split_address(address)
        parts = re.split(r"[._]", at[0]) if at else []
        if len(parts) != 2 or min(map(len, parts)) < 2:
            return []
        known = [p for p in parts if p in w.given]
        tokens = [bare(t) for t in name_tokens(name)[0] if bare(t) not in TITLES]
        if len(known) != 1 or len(tokens) != 2:
            return []
        surname = parts[1 - parts.index(known[0])]
        other = [t for t in tokens if not near(t, surname)]
        return [(other[0], known[0], at[2])] if len(other) == 1 and len(other[0]) > 1 and not near(other[0], known[0]) and other[0] != known[0] else []

    best: dict[str, list] = {}
    for r in _counted(spellings, nicks, share(0.0002, 2)):
        best.setdefault(r["word"], []).append((r["orgs"], r["other"]))
    w.nick = {t: max(c)[1] for t, c in best.items() if max(c)[0] >= 0.8 * sum(n for n, _ in c) and t not in w.given}
    return w


def read_all(spellings: DataFrame, w: Words) -> DataFrame:
    """Spellings with kind, org, surname, given and initial; those that tell nothing are left out."""
    names = ["form", "kind", "org", "surname", "given", "initial", "typed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for form, name, address in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                r = read_spelling(name, address, w)
                if r:
                    rows.append((form, *r))
            yield _pairs(rows, names, [pa.string()] * 7)

    return spellings.select("form", "name", "address").mapInArrow(run, ", ".join(f"{n} string" for n in names))


#: A cell with more strings than this is split by pivots of its own, so many at a time, so often at most.
CELL, PIVOTS, SPLITS = 4000, 16, 6
#: Where names meet by halves a cell may be larger, as its names are not compared with each other.
HALVED_CELL = 200_000
#: Names within this edit distance meet.
RADIUS = 2


def _halves(value: Column, size: Column, n: Column) -> list[Column]:
    """The first and the last letters of a string, of half the length ``n``, less one or two letters in the middle."""
    h = F.floor((n - 1) / 2).cast("int")
    return [F.struct(F.lit(side).alias("side"), n.cast("int").alias("n"), part.alias("half")) for side, part in (("a", F.substring(value, F.lit(1), h)), ("z", F.substring(value, size - h + 1, h)))]


def slip_join(left: DataFrame, right: DataFrame, cell: int | None = None, pivots: int = PIVOTS) -> DataFrame:
    """The pairs of ``radius_join`` that are equal, one edit apart or differ by two neighbours exchanged.

    Such strings agree in the first or in the last half of the right one, whichever the slip spares, so inside a cell
    they meet under that half and the length and large cells make no pairs of all their strings.
    """
    left_cells, right_cells = _cells(left, right, RADIUS, HALVED_CELL if cell is None else cell, pivots)
    m, n = F.length("value"), F.length("value_r")
    asked = left_cells.drop("far").withColumn("k", F.explode(F.flatten(F.array(*(F.array(*_halves(F.col("value"), m, F.greatest(m + d, F.lit(0)))) for d in (-1, 0, 1))))))
    held = right_cells.drop("ring").withColumn("k", F.explode(F.array(*_halves(F.col("value_r"), n, n))))
    met = asked.select("cell", "block", "value", "k.*").join(held.select("cell", "value_r", "k.*"), ["cell", "side", "n", "half"]).select("block", "value", "value_r").distinct()
    apart = met.withColumn("apart", F.levenshtein("value", "value_r", RADIUS)).where("apart >= 0")
    return apart.where((F.col("apart") == 0) | _slip(F.col("value"), F.col("value_r"), F.col("apart")))


def radius_join(left: DataFrame, right: DataFrame, radius: int = RADIUS, cell: int | None = None, pivots: int = PIVOTS) -> DataFrame:
    """(block, value, value_r, apart): the pairs of equal ``block`` whose ``value`` strings lie within an edit distance of ``radius``.

    Both sides have the columns ``block`` and ``value``.  Every block begins as one
    cell.  While a cell holds more than ``cell`` strings of the right side it is split:
    one pivot of each hash bucket of its strings is taken, each right string goes to the
    cell of the nearest pivot, and each left string to all cells that can hold a
    neighbour: those whose pivot is at most twice the radius further than the nearest.
    In the last cells the strings lie in rings by their distance to a pivot (to the
    block's pivot in a cell that was never split), and a left string meets the rings
    within the radius.  Which pivots they are changes the work, never the result.
    """
    left_cells, right_cells = _cells(left, right, radius, CELL if cell is None else cell, pivots)
    spread = left_cells.withColumn("ring", F.explode(F.sequence(F.greatest(F.lit(0), F.col("far") - radius), F.col("far") + radius))).drop("far")
    apart = F.levenshtein("value", "value_r", radius)
    return spread.join(right_cells, ["cell", "ring"]).withColumn("apart", apart).where(F.col("apart") >= 0).select("block", "value", "value_r", "apart")


def _cells(left: DataFrame, right: DataFrame, radius: int, most: int, pivots: int) -> tuple[DataFrame, DataFrame]:
    """((block, value, cell, far), (value_r, cell, ring)): the cells of both sides, each with the distance to the cell's pivot."""
    r = right.select("block", F.col("value").alias("value_r")).where("block is not null and value_r is not null").distinct().withColumn("cell", F.col("block"))
    r = persisted(r, "cells")
    pivot_of = r.groupBy("cell").agg(F.min_by("value_r", F.xxhash64("value_r")).alias("pivot"), F.count("*").alias("n"))
    pivot_of = persisted(pivot_of, "cell-sizes")
    left = left.select("block", "value").where("block is not null and value is not null").distinct().withColumn("cell", F.col("block"))
    left = persisted(left.join(pivot_of.select("cell"), "cell", "left_semi"), "asked-cells")
    full = pivot_of.where(F.col("n") > most).select("cell")
    whole = pivot_of.where(F.col("n") <= most).select("cell", "pivot")
    done_r = [r.join(whole, "cell").withColumn("ring", F.levenshtein("value_r", "pivot")).drop("pivot", "block")]
    done_left = [left.join(whole, "cell").withColumn("far", F.levenshtein("value", "pivot")).drop("pivot")]
    r = r.drop("block")
    for level in range(SPLITS):
        if full.isEmpty():
            break
        # at most one pivot for each bucket
        bucket = F.pmod(F.xxhash64("value_r", F.lit(level)), F.lit(pivots))
        one = r.join(full, "cell", "left_semi").groupBy("cell", bucket.alias("bucket")).agg(F.min("value_r").alias("pivot"))
        chosen = persisted(one.groupBy("cell").agg(F.array_sort(F.collect_set("pivot")).alias("pivots")), "pivots")
        deeper = F.concat_ws("/", "cell", F.col("k").cast("string")).alias("cell")

        def distances(value: str) -> Column:
            return F.transform("pivots", lambda p: F.levenshtein(F.col(value), p))

        near_r = r.join(chosen, "cell").withColumn("d", distances("value_r")).withColumn("ring", F.array_min("d")).withColumn("k", F.array_position("d", F.col("ring")))
        near_r = persisted(near_r.select("value_r", deeper, "ring"), "cells")
        d = left.join(chosen, "cell").withColumn("d", distances("value")).withColumn("least", F.array_min("d"))
        reached = d.select("block", "value", "cell", "least", F.posexplode("d").alias("place", "far")).where(F.col("far") <= F.col("least") + 2 * radius).withColumn("k", F.col("place") + 1)
        reached = persisted(reached.select("block", "value", deeper, "far"), "asked-cells")
        full = persisted(near_r.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > (most if level < SPLITS - 1 else 1 << 62)).select("cell"), "full-cells")
        done_r.append(near_r.join(full, "cell", "left_anti"))
        done_left.append(reached.join(full, "cell", "left_anti"))
        r, left = near_r.select("value_r", "cell"), reached.select("block", "value", "cell")
    return reduce(DataFrame.unionByName, done_left), reduce(DataFrame.unionByName, done_r)


def _edit(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _slip(a: Column, b: Column, apart: Column) -> Column:
    """One edit, or two neighbours exchanged."""
    n = F.length(a)
    swap = F.exists(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.concat(a.substr(F.lit(1), i - 1), a.substr(i + 1, F.lit(1)), a.substr(i, F.lit(1)), a.substr(i + 2, n)) == b)
    return (apart == 1) | ((apart == 2) & (n == F.length(b)) & swap)


ASKED = ["hint", "surname", "given", "initial"]


def _key(kind: str, value: str | None = None, at: str = "at") -> Column:
    """The block of a kind of people at an organisation, or anywhere if ``at`` is ''."""
    return F.concat_ws("|", F.lit(kind), F.coalesce(F.col(value), F.lit("?")) if value else F.lit(""), F.col(at))


def link(contacts: DataFrame) -> DataFrame:
    """(contact_id, entity): rows with the same entity stand for the same person or organisation."""
    base = contacts.select(F.col("contact_id").cast("long").alias("contact_id"), F.col("name").cast("string").alias("name"), F.col("address").cast("string").alias("address"))
    form = F.md5(F.concat(F.coalesce("name", F.lit("\x01")), F.lit("\x02"), F.coalesce(F.lower("address"), F.lit("\x01"))))
    rows = base.where("name is not null or address is not null").withColumn("form", form)
    spellings = persisted(rows.groupBy("form").agg(F.min("name").alias("name"), F.min(F.lower("address")).alias("address")), "spellings")
    read = persisted(read_all(spellings, learn(spellings)), "names-read")

    # people and firms as the addresses at organisations tell them
    at_org = read.where("kind = 'p'")
    full = at_org.where("given is not null").select("org", "surname", "given", "initial").distinct()
    by_initial = full.groupBy("org", "surname", "initial").agg(F.count("*").alias("n"), F.min("given").alias("only"))
    by_surname = full.groupBy("org", "surname").agg(F.count("*").alias("n_all"), F.min("given").alias("only_all"))
    some = at_org.where("given is null").join(by_initial, ["org", "surname", "initial"], "left").join(by_surname, ["org", "surname"], "left")
    chosen = F.when(F.col("n") == 1, F.col("only")).when(F.col("initial").isNull() & (F.col("n_all") == 1), F.col("only_all"))
    columns = ["form", "org", "surname", "given", "initial", "typed"]
    told = at_org.where("given is not null").select(columns).unionByName(some.select("form", "org", "surname", chosen.alias("given"), "initial", "typed"))
    who = F.coalesce(F.col("given"), F.concat(F.lit("~"), F.coalesce("initial", F.lit("?"))))
    told = persisted(told.withColumn("entity", F.concat_ws("|", F.lit("p"), "org", "surname", who)), "told")
    people = persisted(told.select("entity", "org", "surname", "given", "initial").distinct(), "people")
    firms = read.where("kind = 'o'").select("form", "org", "typed")
    orgs = told.select("org").unionByName(firms.where("org is not null").select("org")).distinct()

    # Loose names are looked up under keys that sum up the people they may mean, so that a surname shared by very many
    # people makes no pairs: G a given name, N an initial of people without one, Z people with neither, I an initial, A anybody.
    loose = persisted(read.where("kind = 'n' and surname is not null").select("form", F.col("org").alias("hint"), "surname", "given", "initial").withColumn("at", F.coalesce("hint", F.lit(""))), "loose-names")
    asked = loose.groupBy(*ASKED, "at").agg(F.count("*").alias("spellings"))
    with_given = F.array(_key("G", "given"), _key("I", "initial"), _key("A"))
    without = F.when(F.col("initial").isNotNull(), F.array(_key("N", "initial"), _key("I", "initial"), _key("A"))).otherwise(F.array(_key("Z"), _key("A")))
    shown = people.withColumn("at", F.explode(F.array(F.col("org"), F.lit("")))).withColumn("block", F.explode(F.when(F.col("given").isNotNull(), with_given).otherwise(without)))
    summed = persisted(shown.groupBy("block", F.col("surname").alias("value_r")).agg(F.min("entity").alias("lo"), F.max("entity").alias("hi")), "summed")
    looked = F.when(F.col("given").isNotNull(), F.array(_key("G", "given"), _key("N", "initial"), _key("Z"), _key("L", "given"))).when(F.col("initial").isNotNull(), F.array(_key("I", "initial"), _key("Z"))).otherwise(F.array(_key("A")))
    lookup = asked.withColumn("block", F.explode(looked)).withColumnRenamed("surname", "value")
    kin = asked.where("given is not null").withColumn("block", _key("L", "given")).withColumnRenamed("surname", "value_r")  # loose names among themselves

    # everything meets here: typed names and names of entities
    person_block, firm_block, any_firm = F.concat_ws("|", F.lit("P"), "org"), F.concat_ws("|", F.lit("O"), "org"), F.lit("F")
    typed, org = F.col("typed").alias("value"), F.col("org").alias("value")
    named = told.select(person_block.alias("block"), typed).unionByName(firms.where("org is not null").select(firm_block.alias("block"), typed))
    known = told.select(person_block.alias("block"), F.col("surname").alias("value")).unionByName(orgs.select(firm_block.alias("block"), org))
    met = persisted(radius_join(named, known), "met")
    # names without an organisation meet very many, so only those a slip apart
    named = firms.where("org is null").select(any_firm.alias("block"), typed).unionByName(lookup.select("block", "value"))
    known = orgs.select(any_firm.alias("block"), org).unionByName(summed.select("block", F.col("value_r").alias("value"))).unionByName(kin.select("block", F.col("value_r").alias("value")))
    loosely = persisted(slip_join(named, known), "met-loosely")

    # names at an organisation: the address verifies which of the names met is meant
    settled = told.withColumn("block", person_block).withColumnRenamed("typed", "value").withColumnRenamed("surname", "value_r").join(met, ["block", "value", "value_r"]).select("form", "entity")
    of_firm = firms.where("org is not null").select("form", firm_block.alias("block"), F.col("typed").alias("value"), F.col("org").alias("value_r")).join(met, ["block", "value", "value_r"])
    of_firm = of_firm.select("form", F.concat(F.lit("o|"), "value_r").alias("entity"))
    strays = firms.where("org is null").select("form", "typed")
    best = loosely.where("block = 'F'").withColumn("rough", F.col("apart") > 0)
    best = best.groupBy("value", "rough").agg(F.min("value_r").alias("lo"), F.max("value_r").alias("hi"))
    best = best.groupBy(F.col("value").alias("typed")).agg(F.min_by("lo", "rough").alias("lo"), F.min_by("hi", "rough").alias("hi"))
    stray_of = strays.join(best, "typed", "left").select("form", F.concat(F.lit("o|"), F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.col("typed"))).alias("entity"))

    # loose names: those met exactly count before those met with a slip
    ask = [F.col(c).eqNullSafe(F.col(f"{c}_x")) for c in ASKED]

    def renamed(df: DataFrame) -> DataFrame:
        return df.select(*(F.col(c).alias(f"{c}_x") for c in ASKED), *(c for c in df.columns if c not in ASKED))

    may_slip = F.col("given").isNotNull() | ~F.col("known")
    surnames = people.select(F.col("surname").alias("value")).distinct().withColumn("known", F.lit(True))
    meant = lookup.join(loosely, ["block", "value"]).join(summed, ["block", "value_r"]).join(surnames, "value", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    meant = meant.where((F.col("apart") == 0) | may_slip).withColumn("rough", F.col("apart") > 0).withColumnRenamed("value", "surname")
    meant = meant.groupBy(*ASKED, "rough").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    meant = persisted(meant.groupBy(*ASKED).agg(F.min_by("lo", "rough").alias("lo"), F.min_by("hi", "rough").alias("hi")), "meant")

    own = F.concat_ws("|", F.lit("n"), "at", "surname", F.coalesce(F.col("given"), F.concat(F.lit("~"), F.coalesce("initial", F.lit("?")))))
    alone = asked.where("given is not null").join(renamed(meant), ask, "left_anti").select("given", "at", "surname", "spellings").withColumn("block", _key("L", "given"))
    other = alone.select("block", F.col("surname").alias("value_r"), F.col("spellings").alias("spellings_r"))
    pairs = loosely.where(F.col("block").startswith("L|") & (F.col("apart") > 0)).join(alone.withColumnRenamed("surname", "value"), ["block", "value"]).join(other, ["block", "value_r"])
    larger = pairs.where(F.struct("spellings_r", "value_r") > F.struct("spellings", "value")).groupBy("block", "value").agg(F.min("value_r").alias("lo"), F.max("value_r").alias("hi")).where("lo = hi")
    larger = persisted(larger.select("block", F.col("value").alias("surname"), F.col("lo").alias("larger")), "larger")  # a rare spelling joins the only more frequent one beside it
    twice = larger.select("block", F.col("surname").alias("larger"), F.col("larger").alias("largest"))
    resolved = larger.join(twice, ["block", "larger"], "left").select("block", "surname", F.coalesce("largest", "larger").alias("meant_surname"))

    entity = F.when(F.col("lo") == F.col("hi"), F.col("lo")).when(F.col("lo").isNotNull(), F.concat(F.lit("f|"), F.col("form"))).otherwise(own)
    j = loose.join(renamed(meant), ask, "left").withColumn("block", _key("L", "given")).join(resolved, ["block", "surname"], "left")
    j = j.withColumn("surname", F.when(F.col("lo").isNull() & F.col("given").isNotNull(), F.coalesce("meant_surname", "surname")).otherwise(F.col("surname")))
    loose_of = j.select("form", entity.alias("entity"))

    of = settled.unionByName(of_firm).unionByName(stray_of).unionByName(loose_of)
    return rows.select("contact_id", "form").distinct().join(of, "form").select("contact_id", "entity").distinct()


def linked_pairs(contacts: DataFrame) -> DataFrame:
    """(contact_id_a, contact_id_b), a < b, of rows that stand for the same entity."""
    found = persisted(link(contacts), "entities")
    a = found.select("entity", F.col("contact_id").alias("contact_id_a"))
    b = found.select("entity", F.col("contact_id").alias("contact_id_b"))
    return a.join(b, "entity").where("contact_id_a < contact_id_b").select("contact_id_a", "contact_id_b").distinct()
