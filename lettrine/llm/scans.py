"""Noise of scanned pages: running headers and footers, page numbers, split words, misread characters.

Lines that recur within a text, alike but for misreadings, at the edges of its pages
are running lines; lines that hold only a page number are found by shape and
sequence.  What remains is running text.  Its words, counted over the whole corpus,
make the vocabulary that decides whether a hyphen at a line end split a word and
whether a rare word is a common one with a usual confusion of characters.  With this
the lines are joined into paragraphs.

The vocabulary stays a table; what is sent to the executors are only the misread
forms and the words with hyphens of their own, in blocks of at most ``BLOCK``
entries.  One block serves in a single pass.  Several blocks each tell the forms that
a text holds; a last pass reads each text with all of its forms, so results don't
depend on ``BLOCK``.

Defined results: null and empty texts have no lines; texts without page traces come
out as they are, their lines joined; a line may have several kinds; repeated rows
count once by record and position; texts of any length are read whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettrine.llm.base import persisted

#: What is read, and what stands on the page.
CONFUSIONS = (
    ("c", "e"), ("e", "c"), ("ri", "n"), ("0", "o"), ("5", "s"), ("1", "l"), ("ii", "u"), ("rn", "m"), ("!", "i"), ("ø", "a"), ("cl", "d"),
    ("d", "cl"), ("†", "t"), ("e'", "é"), ("y", "v"), ("ü", "ti"), ("ü", "ri"), ("|", "l"), ("b", "h"), ("m", "in"), ("m", "rn"), ("9", "g"), ("ê", "è"),
    ("ﬁ", "fi"), ("ﬂ", "fl"), ("h", "li"), ("l", "i"), ("vv", "w"), ("e", "é"),
)
#: A repaired word must be so many times as frequent as the misread one, and occur so often.
RATIO, FREQUENT = 20, 8
#: Dropping an accent is also a habit of writing; such repairs need more.
ACCENT_RATIO = 150
BLOCK = 400_000
FLUSH = 150_000

_EDGE = " \t\r\x0c\xa0.,;:?…()[]{}«»\"“”„*–—-'’‘`<>•·"
_ELISION = re.compile(r"^(?:l|d|qu|n|s|j|c|m|t|jusqu|lorsqu|puisqu)['’](?=.)")
_BAD_ELISION = re.compile(r"^[1|!]['’](?=\w)")
_INSIDE = re.compile(r"(?<=[^\W\d_])[†ø|!](?=[^\W\d_])|(?<=[a-zà-ÿ])[0159](?=[a-zà-ÿ])")
_NUMBER = r"(?:page|pg?\.?|folio|seite)?\s*(?:\d{1,4}|\b[ivxl]{1,6}\b)(?:\s*(?:/|of|sur|de|von)\s*\d{1,4})?"
_PAGE = re.compile(rf"[\s\-–—\[\]().|·*~]*{_NUMBER}[\s\-–—\[\]()|·*~]*", re.I)
_PLAIN = re.compile(r"\d{1,4}|[ivxl]{1,6}", re.I)
_NUMBERED = re.compile(r"\d{1,3}\s*[-–.)]\s")
_ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50}
_TAIL = re.compile(rf"^(?P<core>.*\S)(?:\s{{2,}}|\t|\s[|–—-]\s)[\-–—\[\]()| ]*(?:{_NUMBER})[\-–—\[\]()| ]*$", re.I)
_HEAD = re.compile(rf"^(?:[\-–—\[(|] ?{_NUMBER}[\-–—\])| ]*|(?:page|p\.) ?\d+\S*(?: ?(?:of|sur|de|von|/) ?\d+)?)(?:\s{{2,}}|\t)(?P<core>\S.*)$", re.I)
_GOES_ON = re.compile(r"[^\W\d_A-ZÀ-Þ]|[0159!†|][a-zà-ÿ]")
_SPLIT = re.compile(r"([^\s\-­‐¬]+(?:-[^\s\-]+)*)[\-­‐¬]$")


_WIDE = re.compile(r"\s{3,}")
#: Characters at the end of a line in which its page number is looked for, wide blanks counted as two.
_TAIL_CHARS = 64


def _core(line: str) -> tuple[str, bool]:
    """The line without a page number at its end or beginning; whether there was one."""
    if "  " in line or "\t" in line or any(ch.isdigit() for ch in line):
        line = _WIDE.sub("  ", line)
        start = max(0, len(line) - _TAIL_CHARS)
        m = _TAIL.match(line[start:])
        core = line[:start] + m["core"] if m else (h["core"] if (h := _HEAD.match(line)) else "")
        if any(ch.isalpha() for ch in core):
            return core, True
    return line, False


def _value(number: str) -> int:
    if number.isdigit():
        return int(number)
    each = [_ROMAN[ch] for ch in number.lower()]
    return sum(-x if x < max(each[k:]) else x for k, x in enumerate(each))


def _alike(a: str, b: str) -> bool:
    """Equal but for misreadings: never if digits differ from digits."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 4:
        return False
    i = 0
    n = min(len(a), len(b))
    while i < n and a[i] == b[i]:
        i += 1
    j = 0
    while j < n - i and a[-1 - j] == b[-1 - j]:
        j += 1
    x, y = a[i : len(a) - j], b[i : len(b) - j]
    if i + j < 0.5 * n:
        return False
    if len(x) <= 3 and len(y) <= 3:
        return not (x.isdigit() and y.isdigit())
    if i + j < 6:
        return False
    m = SequenceMatcher(None, a, b, autojunk=False)
    if m.quick_ratio() < 0.85 or m.ratio() < 0.85:
        return False
    return not any(op == "replace" and a[p:q].isdigit() and b[r:s].isdigit() for op, p, q, r, s in m.get_opcodes())


def _ends(c: str) -> set[str]:
    """Keys of which lines that are alike share one: half of the shorter line agrees at both ends together, so a quarter
    at one of them; a misreading seldom hits both ends of a short line."""
    a, b = max(2, len(c) // 4), max(2, len(c) // 4 - 1)  # the other line may be four characters shorter
    return {c[:a], "$" + c[-a:], c[:b], "$" + c[-b:]}


def furniture(lines: list[str]) -> dict[int, str]:
    """``running`` or ``page_number`` for each line that belongs to the page, not to the text."""
    text = [x.strip() for x in lines]
    full = [i for i, t in enumerate(text) if t]
    out: dict[int, str] = {}
    if not full:
        return out
    place = {i: k for k, i in enumerate(full)}
    feeds = {i for i, x in enumerate(lines) if "\x0c" in x}

    def fed(k: int) -> bool:
        """A page ends just before or after the k-th full line."""
        if not feeds:
            return False
        first = full[k - 1] + 1 if k else 0
        last = full[k + 1] if k + 1 < len(full) else len(lines) - 1
        return any(j in feeds for j in range(first, last + 1))

    plain = []
    for i in full:
        t = text[i]
        if len(t) <= 24 and _PAGE.fullmatch(t):
            if _PLAIN.fullmatch(t):
                plain.append(i)
            else:
                out[i] = "page_number"
    numbers = {i: _value(text[i]) for i in plain}
    first_at: dict[int, int] = {}
    last_at: dict[int, int] = {}
    for i, v in numbers.items():
        first_at.setdefault(v, i)
        last_at[v] = i
    for i in plain:
        k = place[i]
        alone = (i == 0 or not text[i - 1]) and (i + 1 == len(text) or not text[i + 1])
        steps = last_at.get(numbers[i] + 1, -1) > i or first_at.get(numbers[i] - 1, i) < i
        if steps or alone or k in (0, len(full) - 1) or fed(k):
            out[i] = "page_number"

    cores = {}
    for i in full:
        if i in out:
            continue
        core, numbered = _core(text[i])
        first = next((ch for ch in core if ch.isalnum()), "")
        if len(core) >= 3 and first and not first.islower() and core[-1] not in ".,;:":
            cores[i] = (core.lower(), numbered)
    if len(cores) < 2:
        return out
    # lines that are alike come into one group, also by way of a third
    forms: list[str] = []
    parent: list[int] = []
    near_by: dict[str, list[int]] = {}
    form_of: dict[str, int] = {}

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = k = parent[parent[k]]
        return k

    for c, _ in cores.values():
        if c not in form_of:
            k = form_of[c] = len(forms)
            forms.append(c)
            parent.append(k)
            for e in _ends(c):
                near = near_by.setdefault(e, [])
                for other in near:
                    if root(other) != root(k) and _alike(forms[other], c):
                        parent[root(k)] = root(other)
                near.append(k)
    gathered: dict[int, list[int]] = {}
    for i, (c, _) in cores.items():
        gathered.setdefault(root(form_of[c]), []).append(i)
    groups = [(forms[k], members) for k, members in gathered.items()]
    groups = [(c, members) for c, members in groups if len(members) > 1]
    if not groups:
        return out
    likely = {i for _, members in groups for i in members}

    # the nearest lines of text before and after each full line
    before: list[int | None] = [None] * len(full)
    after: list[int | None] = [None] * len(full)
    for k in range(1, len(full)):
        p = full[k - 1]
        before[k] = before[k - 1] if p in out or p in likely else p
    for k in range(len(full) - 2, -1, -1):
        n = full[k + 1]
        after[k] = after[k + 1] if n in out or n in likely else n

    for c, members in groups:
        flows = breaks = edges = 0
        for i in members:
            p, n = before[place[i]], after[place[i]]
            finished = p is None or text[p][-1] in ".!?:»\"”"
            lower = n is not None and text[n][0].islower()
            flows += finished and lower and n == i + 1
            breaks += not finished
            k = place[i]
            around = [full[j] for j in (k - 1, k + 1) if 0 <= j < len(full)]
            edges += bool(i and text[i - 1]) or i + 1 < len(text) and bool(text[i + 1])
            edges += k in (0, len(full) - 1) or any(out.get(j) == "page_number" for j in around) or fed(k)
        if _NUMBERED.match(c) and breaks < len(members):
            continue  # numbered headings may recur by chance
        if flows * 3 <= len(members) and (breaks or edges or any(cores[i][1] for i in members)):
            for i in members:
                out[i] = "running"
    for i in plain:
        k = place[i]
        if i not in out and any(out.get(full[j]) == "running" for j in (k - 1, k + 1) if 0 <= j < len(full)):
            out[i] = "page_number"
    return out


def word_of(token: str) -> str | None:
    """The form of a token that is counted; None for numbers, codes and addresses."""
    t = token.strip(_EDGE).lower()
    if len(t) < 3 or "@" in t or "/" in t:
        return None
    if _BAD_ELISION.match(t):
        return t
    t = _ELISION.sub("", t)
    digits = sum(ch.isdigit() for ch in t)
    if len(t) < 3 or len(t) > 40 or digits > 2 or digits * 2 >= len(t):
        return None
    return t


def splits(lines: list[str], kinds: dict[int, str]) -> list[tuple[int, int, str, str]]:
    """(line, next line, left, right) for each word that may be split at a line end."""
    out = []
    body = [i for i, x in enumerate(lines) if i not in kinds and x.strip()]
    for i, j in zip(body, body[1:], strict=False):
        left = lines[i].rstrip()
        if left and left[-1] in "-­‐¬" and (m := _SPLIT.search(left)):
            right = lines[j].split(maxsplit=1)[0]
            word = _ELISION.sub("", m[1].strip(_EDGE).lower())
            r = right.strip(_EDGE).lower()
            if _GOES_ON.match(right) and word and r and any(ch.isalpha() for ch in word) and "@" not in word + r:
                out.append((i, j, word, r))
    return out


def _counts(texts: Iterator[str]) -> Iterator[Counter]:
    """Words as (word, '') and splits as (left, right), in parts of bounded size."""
    c: Counter = Counter()
    tokens: Counter = Counter()

    def told() -> Counter:
        for t, n in tokens.items():
            if (w := word_of(t)) is not None:
                c[w, ""] += n
        return c

    for text in texts:
        lines = text.split("\n")
        kinds = furniture(lines)
        cut = splits(lines, kinds)
        for _, _, left, right in cut:
            c[left, right] += 1
        ends, starts = {i for i, *_ in cut}, {j for _, j, *_ in cut}
        for i, x in enumerate(lines):
            if i not in kinds:
                t = x.split()
                tokens.update(t[i in starts : len(t) - (i in ends)])
        if len(tokens) + len(c) > FLUSH:
            yield told()
            c, tokens = Counter(), Counter()
    yield told()


def scanned(emails: DataFrame) -> DataFrame:
    """(record_id, att_pos, text) of the attachments that are no e-mail bodies."""
    kept = F.filter(F.transform(F.coalesce("attachments", F.array()), lambda a, i: F.struct(i.cast("long").alias("att_pos"), a["is_email_body"].alias("body"), a["extracted_text"].alias("text"))), lambda a: ~F.coalesce(a["body"], F.lit(False)) & (F.length(a["text"]) > 0))
    return emails.select(F.col("record_id").cast("long").alias("record_id"), F.explode(kept).alias("a")).select("record_id", "a.att_pos", "a.text")


def vocabulary(texts: DataFrame) -> DataFrame:
    """(word, right, n): words of the running text with an empty ``right``, and words split at line ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _counts(t for batch in batches for t in batch.column(0).to_pylist()):
            keys = list(c)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array(list(c.values()), pa.int64())], names=["word", "right", "n"])

    return texts.select("text").mapInArrow(run, "word string, right string, n long").groupBy("word", "right").agg(F.sum("n").alias("n"))


def repairs(word: str) -> Iterator[tuple[str, int, float]]:
    """(repaired word, place, ratio needed) with one confusion undone."""
    if (m := _BAD_ELISION.match(word)) is not None:
        yield word[m.end() :], 0, 0.1
    for wrong, right in CONFUSIONS:
        start = word.find(wrong)
        odd = not wrong.isalpha() or wrong in "øü"
        while start >= 0:
            fixed = word[:start] + right + word[start + len(wrong) :]
            yield _ELISION.sub("", fixed), start, 0.1 if odd else ACCENT_RATIO if (wrong, right) == ("e", "é") else RATIO
            start = word.find(wrong, start + 1)


def lexicon(vocab: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Misread forms (word, right, place, repair) and words with a hyphen of their own (left, right)."""
    plain = vocab.where("right = ''").select("word", F.col("n").alias("n_plain"))
    asked = vocab.select("word", "right", "n").where(F.length("word") + F.length("right") >= 3)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["word", "right", "n", "repair", "place", "needed"]
        types = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.float64())
        for batch in batches:
            rows = []
            for w, r, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows.extend((w, r, n, f, p, x) for f, p, x in repairs(w + r))
                if r:  # the word may have a hyphen of its own there
                    rows.extend((w, r, n, f, p - (p > len(w)), x) for f, p, x in repairs(f"{w}-{r}"))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    tried = asked.mapInArrow(run, "word string, right string, n long, repair string, place int, needed double")
    hits = tried.join(plain.where(F.col("n_plain") >= FREQUENT).select(F.col("word").alias("repair"), "n_plain"), "repair").where(F.col("n_plain") >= F.col("needed") * F.col("n"))
    # a split word that is itself a common word is not misread, however rarely it is split just there
    whole = plain.select(F.concat("word").alias("joined"), F.col("n_plain").alias("n_whole"))
    hits = hits.withColumn("joined", F.concat("word", "right")).join(whole, "joined", "left").where((F.col("right") == "") | (F.coalesce("n_whole", F.lit(0)) * F.col("needed") <= F.col("n_plain")))
    misread = hits.groupBy("word", "right").agg(F.max_by(F.struct("place", "repair"), F.struct("n_plain", "repair")).alias("best")).select("word", "right", "best.place", "best.repair")

    pairs = vocab.where("right <> ''").select("word", "right")
    own = pairs.withColumn("with", F.concat_ws("-", "word", "right")).withColumn("without", F.concat("word", "right"))
    counted = own.join(plain.select(F.col("word").alias("with"), F.col("n_plain").alias("n_with")), "with").join(plain.select(F.col("word").alias("without"), F.col("n_plain").alias("n_without")), "without", "left")
    return misread, counted.where(F.col("n_with") > F.coalesce("n_without", F.lit(0))).select("word", "right")


#: Forms as they are sent: (word, right, place, repair); a word with a hyphen of its own has no place and no repair.
FORMS = "word string, right string, place int, repair string"


def learned(texts: DataFrame) -> DataFrame:
    """The forms of the corpus."""
    misread, own = lexicon(persisted(vocabulary(texts), "vocabulary"))
    none = F.lit(None)
    return persisted(misread.unionByName(own.select("word", "right", none.cast("int").alias("place"), none.cast("string").alias("repair"))), "forms")


def _blocks(forms: DataFrame, size: int) -> Iterator[tuple[int, list]]:
    """(number of blocks, forms) for each block."""
    n = -(-forms.count() // size) or 1
    for b in range(n):
        part = forms if n == 1 else forms.where(F.pmod(F.xxhash64("word", "right"), F.lit(n)) == b)
        yield n, [tuple(r) for r in part.collect()]


class Repairer:
    """Kinds of lines and repaired text, by the learned forms."""

    def __init__(self, forms: list[tuple]):
        self.misread = {(w, r): (place, repair) for w, r, place, repair in forms if place is not None}
        self.own = {(w, r) for w, r, place, _ in forms if place is None}
        self.after: dict[str, set[str]] = {}
        self.before: dict[str, set[str]] = {}
        for left, right in self.own:
            self.after.setdefault(left, set()).add(right)
            self.before.setdefault(right, set()).add(left)
        self._tokens: dict[str, bool] = {}

    def bad(self, token: str) -> bool:
        known = self._tokens.get(token)
        if known is None:
            w = word_of(token)
            known = w is not None and ((w, "") in self.misread or bool(_INSIDE.search(w)))
            if len(self._tokens) > 500_000:
                self._tokens.clear()
            self._tokens[token] = known
        return known

    def own_hyphen(self, left: str, right: str) -> bool:
        """The word has a hyphen of its own there, perhaps with one half misread."""
        if (left, right) in self.own:
            return True
        return any(_alike(x, right) for x in self.after.get(left, ()) if len(x) > 3) or any(_alike(x, left) for x in self.before.get(right, ()) if len(x) > 3)

    def forms_of(self, text: str) -> set[tuple]:
        """The forms that bear on a text."""
        lines = text.split("\n")
        page = furniture(lines)
        found = set()
        for _, _, left, right in splits(lines, page):
            if (hit := self.misread.get((left, right))) is not None:
                found.add((left, right, *hit))
            if self.own_hyphen(left, right):
                found.add((left, right, None, None))
        for t in {t for i, x in enumerate(lines) if i not in page for t in x.split()}:
            w = word_of(t)
            if w is not None and (hit := self.misread.get((w, ""))) is not None:
                found.add((w, "", *hit))
        return found

    def kinds(self, text: str) -> list[tuple[int, str]]:
        lines = text.split("\n")
        page = furniture(lines)
        out = list(page.items())
        cut = splits(lines, page)
        misread = set()
        ends, starts = set(), set()
        for i, j, left, right in cut:
            ends.add(i)
            starts.add(j)
            if not self.own_hyphen(left, right):
                out.append((i, "hyphen"))
            hit = self.misread.get((left, right))
            if hit:
                misread.add(i if hit[0] < len(left) else j)
        for i, x in enumerate(lines):
            if i not in page and i not in misread:
                t = x.split()
                if any(map(self.bad, t[i in starts : len(t) - (i in ends)])):
                    misread.add(i)
        out.extend((i, "misread") for i in misread)
        return out

    @staticmethod
    def _in_place(token: str, word: str, fixed: str) -> str:
        """The token with its word replaced, in the word's letter case."""
        at = token.lower().find(word)
        if at < 0:
            return token
        bare = token[at : at + len(word)]
        if _BAD_ELISION.match(word):
            fixed = "l'" + fixed
        if bare.isupper() and len(bare) > 1:
            fixed = fixed.upper()
        elif bare[:1].isupper():
            fixed = fixed[:1].upper() + fixed[1:]
        return token[:at] + fixed + token[at + len(word) :]

    def _mended(self, token: str) -> str:
        w = word_of(token)
        hit = self.misread.get((w, "")) if w else None
        return self._in_place(token, w, hit[1]) if hit else token

    def _joined(self, head: str, tail: str, left: str, right: str) -> str:
        """The two halves of a split word as one word, mended."""
        whole = head + tail if self.own_hyphen(left, right) else head[:-1] + tail
        hit = self.misread.get((left, right))
        if hit is None:
            return whole if self.own_hyphen(left, right) else self._mended(whole)
        plain = self._in_place(whole, left + right, hit[1])
        return plain if plain != whole else self._in_place(whole, f"{left}-{right}", hit[1])

    def repaired(self, text: str) -> str:
        """The text without page furniture, split words joined, misread words mended, one line for each paragraph."""
        lines = text.split("\n")
        page = furniture(lines)
        joins = {i: (left, right) for i, _, left, right in splits(lines, page)}
        paragraphs: list[list[str]] = []  # each a list of words
        cut: tuple[str, str] | None = None
        glue = gap = False
        for i, x in enumerate(lines):
            if i in page:
                continue
            tokens = x.split()
            if not tokens:
                gap = True
                continue
            first, last = tokens[0], tokens[-1]
            mended = [self._mended(t) for t in tokens]
            if i in joins:
                mended[-1] = last  # mended with its other half
            now = paragraphs[-1] if paragraphs else None
            going_on = now and (cut or glue or first[:1].islower() or not gap and now[-1][-1] not in ".!?:")
            if now and (not gap or going_on):
                if cut:
                    now[-1] = self._joined(now[-1], first, *cut)
                    now.extend(mended[1:])
                elif glue:
                    now[-1] += mended[0]
                    now.extend(mended[1:])
                else:
                    now.extend(mended)
            else:
                paragraphs.append(mended)
            end = paragraphs[-1][-1]
            cut = joins.get(i)
            glue = cut is None and len(end) > 1 and end[-1] == "-" and end[-2].isalnum()  # a reference with a hyphen of its own goes on
            gap = False
        return "\n\n".join(" ".join(p) for p in paragraphs)


def _with_forms(texts: DataFrame) -> tuple[DataFrame, object | None]:
    """(texts with a column ``forms``, broadcast of the only block or None): a text's own forms where there are several blocks."""
    spark = texts.sparkSession
    found = shared = None
    for n, block in _blocks(learned(texts), BLOCK):
        shared = spark.sparkContext.broadcast(Repairer(block))
        if n == 1:
            return texts.withColumn("forms", F.lit(None).cast(f"array<struct<{FORMS.replace(' ', ':')}>>".replace(",:", ","))), shared

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(r, a, *f) for r, a, t in zip(*(c.to_pylist() for c in batch.columns), strict=True) for f in shared.value.forms_of(t)]
                cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["record_id", "att_pos", "word", "right", "place", "repair"])

        part = texts.mapInArrow(run, f"record_id long, att_pos long, {FORMS}")
        found = part if found is None else found.unionByName(part)
    each = found.groupBy("record_id", "att_pos").agg(F.collect_set(F.struct("word", "right", "place", "repair")).alias("forms"))  # no more than the words of one text
    return texts.join(each, ["record_id", "att_pos"], "left"), None


def _repairers(batch: pa.RecordBatch, shared) -> Iterator[tuple[int, int, str, Repairer]]:
    """(record_id, att_pos, text, its repairer)."""
    only = shared.value if shared is not None else None
    for r, a, t, forms in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        yield r, a, t, only or Repairer([(f["word"], f["right"], f["place"], f["repair"]) for f in forms or []])


def line_kinds(emails: DataFrame) -> DataFrame:
    """(record_id, att_pos, line_no, kind) of the noisy lines."""
    texts, shared = _with_forms(scanned(emails))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rec, pos, no, kind = [], [], [], []
            for r, a, t, repairer in _repairers(batch, shared):
                found = repairer.kinds(t)
                rec.extend([r] * len(found))
                pos.extend([a] * len(found))
                no.extend(i for i, _ in found)
                kind.extend(k for _, k in found)
            yield pa.RecordBatch.from_arrays([pa.array(rec, pa.int64()), pa.array(pos, pa.int64()), pa.array(no, pa.int64()), pa.array(kind, pa.string())], names=["record_id", "att_pos", "line_no", "kind"])

    return texts.mapInArrow(run, "record_id long, att_pos long, line_no long, kind string")


def repaired_texts(emails: DataFrame) -> DataFrame:
    """(record_id, att_pos, text): continuous readable paragraphs."""
    texts, shared = _with_forms(scanned(emails))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fixed = [repairer.repaired(t) for _, _, t, repairer in _repairers(batch, shared)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fixed, pa.string())], names=["record_id", "att_pos", "text"])

    return texts.mapInArrow(run, "record_id long, att_pos long, text string")
