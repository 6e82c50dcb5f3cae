"""The text that the sender of an e-mail wrote, without quoted history, signatures and disclaimers.

Three sources of evidence mark lines that the sender did not newly write:

* inherited text: the messages of a thread form a generalised suffix automaton over
  words; a long match with an earlier message is inherited, however it is wrapped.
  Long threads are cut into runs of neighbours in time, so no thread is gathered into
  one task; what a run inherits from earlier ones it knows by hashed word sequences,
  whose union is exactly what an automaton of all earlier messages would match;
* the layout of quoting: quote marks, introducing lines and header blocks.  Most
  quoted messages are not themselves rows, so the automaton alone can't find them;
* endings: lines that recur behind the closing formulas, or at the very end, of several
  messages of their sender; then what follows the closing formula or a signature
  delimiter, mobile footers, and paragraphs whose sentences recur at the end of many
  messages of their sender, of the sender's domain or of everyone.

Defined results: null and empty texts have no lines; blank lines belong to nothing;
closing formulas and a bare given name below them are the sender's; copies of one
message don't inherit from each other; repeated rows count once.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lettrine.llm.base import persisted, words

#: A match of so many words with an earlier message is inherited.
INHERITED = 15
#: Messages of a thread that share an automaton; a bound of memory only, results don't depend on it.
RUN = 250
#: A sentence is a recurring ending of a sender, a domain or everyone if it ends this share of their messages, and so many.
ENDING_SHARE, ENDING_LEAST = 0.001, 8
#: A line belongs to a sender's ending if it stands behind the closing formula in so many different messages of the sender,
#: or at the end of so many without a closing formula, and in this share of the sender's messages.
LINE_CLOSED, LINE_OPEN, LINE_SHARE = 2, 3, 0.02
#: Sizes of a layout, not of a text: an introducing line, wrapped, has at most so many characters; a delimiter stands at most
#: so many lines above the end of its part, else it divides the own text; a signature block has at most so many lines, each of
#: so many characters. No row of sf0.1 depends on any of them; they keep dividers, lists and long lines of other texts.
INTRODUCTION_CHARS, DELIMITER_LINES, BLOCK_LINES, SIGNATURE_CHARS = 260, 11, 8, 70
FLUSH = 100_000
_STEP = np.uint64(0x9E3779B97F4A7C15)

_QUOTE = re.compile(r"\s*(?:[>|]\s?)+")
_FIELD = re.compile(r"^\s*\*?\s*(De|From|Von|Envoyé|Sent|Date|À|A|To|An|Cc|Cci|Bcc|Objet|Subject|Betreff)\s?:\s?\*?\s*(.*)$", re.I)
_FROM = re.compile(r"^\s*\*?\s*(?:De|From|Von)\s?:", re.I)
_RULE = re.compile(r"^\s*(?:_{5,}|-{2,}\s*[^\W\d_][^-]*-{2,})\s*$")
_FORWARDED = re.compile(r"^\s*(?:début du message (?:réexpédié|transféré)|begin forwarded message|message (?:transféré|original|d['’]origine))\s*:?\s*$", re.I)
_ADDRESS = re.compile(r"[<(\[]?[\w.+'-]+@[\w.-]+\.\w+[>)\]]?")
_WHEN = re.compile(r"\d{1,2}\s?[:h]\s?\d{2}|\b\d{1,2}[/.-]\d{1,2}[/.-]\d{2,4}\b|\b(?:19|20)\d\d\b")
_DELIMITER = re.compile(r"^\s*(?:-{2,}|_{2,}|—+|–+|\*{3,}|(?:\* ){2,}\*|={3,}|~{2,})\s*$")
_MOBILE = re.compile(r"^\s*(?:envoyé (?:de|depuis|à partir de|avec|via)\b|sent (?:from|via|with)\b|get (?:the|outlook|my)\b.*\b(?:app|for)\b|obtenez\b.*\bapp|télécharge[rz]\b.*\bapp|von meinem\b|gesendet von\b).{0,70}$", re.I)
_NOTICE = re.compile(
    r"confidenti|privileged|secret professionnel|seul(?:s)? destinataire|(?:meant|intended|solely) (?:only )?for (?:its|the)|addressee|unauthori[sz]ed (?:disclosure|use|copying)|diffusion non autorisée|"
    r"décline toute responsabilité|accepts no liability|views expressed|adresse automatique|automated address|before printing|avant d['’]imprimer|virus|no threat found|reçus? par erreur|received (?:it|this) in error|engagement contractuel|no contract is formed",
    re.I,
)
#: Closing formulas.
CLOSINGS = frozenset(
    "cordialement|bien cordialement|très cordialement|cdlt|bien à vous|salutations distinguées|salutations|sincères salutations|merci d'avance|merci|bonne journée|bonne soirée|bien amicalement|amicalement|à bientôt|respectueusement|"
    "regards|kind regards|best regards|warm regards|best|best wishes|many thanks|thanks|thank you|yours sincerely|yours faithfully|yours truly|sincerely|cheers|all the best".split("|")
)
_CLOSING = re.compile(r"^\s*([^\W\d_][\w' ’-]{1,34}?)\s*[,.!]?\s*$")
_GIVEN = re.compile(r"^\s*[^\W\d_]+(?:[-' ’]?[^\W\d_]+)?\.?\s*$")
_NAME = re.compile(r"^\s*(?:(?:M|Mr|Mme|Mrs|Ms|Dr|Me|Mlle)\.?\s+)?[A-ZÀ-Þ][\w'’.-]*(?:\s+[A-ZÀ-Þ][\w'’.-]*){1,3}\s*$")
_CONTACT = re.compile(
    r"^\s*(?:t|t[ée]l|t[ée]l[ée]phone|mob|mobile|portable|port|ligne directe|direct(?: line)?|phone|fax|e-?mail|mail|courriel|web|site)\b[\s.:]*(?:[+(]?\d|[\w.+-]+@|www)|"
    r"^\s*(?:www\.|https?://)|^\s*[\w.+-]+@[\w.-]+\s*$|^\s*[☎📞]|\b\d{5}\b|^\s*(?:flat|apt|appt?|bât)\b|^\s*\d{1,4}\s*(?:bis|ter)?,?\s+[^\W\d_]",
    re.I,
)


def _bare(line: str) -> str:
    m = _QUOTE.match(line)
    return line[m.end() :] if m else line


def introduction(lines: list[str], i: int) -> int:
    """Lines from ``i`` on that introduce a quoted message; 0 if there is none."""
    first = lines[i].strip()
    if len(first) < 8:
        return 0
    joined = first
    for n in (1, 2, 3):
        if n > 1:
            if i + n > len(lines) or not lines[i + n - 1].strip():
                return 0
            joined += " " + lines[i + n - 1].strip()
        if len(joined) > INTRODUCTION_CHARS:
            return 0
        if joined.endswith(":"):
            return n if _ADDRESS.search(joined) and _WHEN.search(joined) or _WHEN.search(joined) and re.search(r"\b(?:wrote|a écrit|schrieb)\b", joined) else 0
        if joined[-1] in ".!?;":
            return 0
    return 0


def header_block(lines: list[str], i: int) -> bool:
    """A forwarded or original message begins at line ``i``."""

    def fields(k: int) -> int:
        names = set()
        for x in lines[k : k + 6]:
            m = _FIELD.match(x)
            if not m:
                break
            names.add(m[1].lower())
        return len(names)

    line = lines[i]
    if _FROM.match(line):
        return fields(i) >= 3 or (fields(i) >= 2 and bool(_ADDRESS.search(line)))
    if _RULE.match(line) or _FORWARDED.match(line):
        k = i + 1
        while k < len(lines) and k <= i + 2 and not lines[k].strip():
            k += 1
        return k < len(lines) and bool(_FIELD.match(lines[k])) and fields(k) >= 2
    return False


def quoted(lines: list[str]) -> list[bool]:
    """Lines that belong to quoted messages by layout: marks, introducing lines, header blocks."""
    n = len(lines)
    out = [False] * n
    introduced = False
    i = 0
    while i < n:
        line = lines[i]
        if not line.strip():
            i += 1
            continue
        mark = _QUOTE.match(line)
        if mark:
            j = i
            while j < n and _QUOTE.match(lines[j]):
                j += 1
            said = [b for x in lines[i:j] if (b := _bare(x).strip())]
            amount = len(said) == 1 and re.match(r"[\d  .,]+(?:EUR|€|\$|%|USD|GBP|£)", said[0])
            if (introduced and not amount) or len(said) > 1 or (said and mark[0].count(">") > 1):
                out[i:j] = [True] * (j - i)
            i = j
            continue
        if header_block(lines, i):
            out[i:] = [True] * (n - i)
            return out
        k = introduction(lines, i)
        if k:
            out[i : i + k] = [True] * k
            introduced = True
            i += k
            nxt = i
            while nxt < n and not lines[nxt].strip():
                nxt += 1
            if nxt < n and not _QUOTE.match(lines[nxt]):
                out[i:] = [True] * (n - i)
                return out
            continue
        i += 1
    return out


def _closing(line: str, first: bool) -> bool:
    m = _CLOSING.match(line) if len(line) <= 60 else None
    if not m:
        return False
    text = m[1].strip().lower().replace("’", "'")
    if text in CLOSINGS:
        return True
    return not first and line.rstrip().endswith(",") and len(text.split()) <= 4 and not re.match(r"(?:bonjour|bonsoir|hello|hi|dear|cher|chère|good|madame|monsieur|all)\b", text)


def sentences(paragraph: str) -> list[str]:
    """A paragraph's sentences in one form, whatever the wrapping and what stands before a colon."""
    text = re.sub(r"\s+", " ", paragraph).strip().lower()
    return [p for p in (s.strip(" .") for s in re.split(r"(?<=[.;!?]) |(?<=\w) ?: ", text)) if len(p.split()) > 2]


def _segments(lines: list[str], taken: list[bool]) -> Iterator[tuple[int, int]]:
    i = 0
    while i < len(lines):
        if taken[i]:
            i += 1
            continue
        j = i
        while j < len(lines) and not taken[j]:
            j += 1
        yield i, j
        i = j


def _paragraphs(lines: list[str], i: int, j: int) -> list[tuple[int, int]]:
    out, k = [], i
    while k < j:
        if not lines[k].strip():
            k += 1
            continue
        m = k
        while m < j and lines[m].strip():
            m += 1
        out.append((k, m))
        k = m
    return out


def endings(lines: list[str], taken: list[bool], recurring: frozenset[str]) -> list[bool]:
    """Signatures, mobile footers and disclaimers in the text that layout leaves to the sender."""
    out = [False] * len(lines)

    def mark(a: int, b: int) -> None:
        for k in range(a, b):
            if lines[k].strip():
                out[k] = True

    for i, j in _segments(lines, taken):
        full = [k for k in range(i, j) if lines[k].strip()]
        if not full:
            continue
        for k in full:
            if _MOBILE.match(lines[k]):
                out[k] = True
        end = j
        for a, b in reversed(_paragraphs(lines, i, j)):
            text = " ".join(lines[a:b])
            if all(out[k] for k in range(a, b)):
                end = a
                continue
            # a notice may follow the signature without a blank line
            start = a
            if not _notice(text, recurring):
                break
            while start < b and not _notice_starts(lines[start], recurring):
                start += 1
            if start == b:
                start = a
            mark(start, b)
            end = start
            if start > a:
                break
        closed = next((k for k in reversed(full) if k < end and _closing(lines[k], k == full[0] and len(full) > 2)), None)
        delimiter = next((k for k in [x for x in full if x < end][-DELIMITER_LINES:] if _DELIMITER.match(lines[k])), None)
        if delimiter is not None:
            mark(delimiter, end)
            end = min(end, delimiter)
        if closed is not None and closed < end:
            below = [k for k in full if closed < k < end and not out[k]]
            if below and below[0] == closed + 1 and _GIVEN.match(lines[below[0]]) and not _NAME.match(lines[below[0]]):
                below = below[1:]
            for k in below:
                if _signs(lines[k]):
                    out[k] = True
                else:
                    break
        else:
            before = [k for k in full if k < end]
            named = next((k for n, k in enumerate(before) if len(before) - n <= BLOCK_LINES and _NAME.match(lines[k]) and (_sign_block(lines, before[n:]) or n == len(before) - 1 and n and not lines[k - 1].strip())), None)
            if named is not None:
                mark(named, end)
    return out


def _notice(text: str, recurring: frozenset[str]) -> bool:
    if _NOTICE.search(text):
        return True
    parts = sentences(text)
    return bool(parts) and all(p in recurring for p in parts)


def _notice_starts(line: str, recurring: frozenset[str]) -> bool:
    """A line of a notice rather than of a signature above it."""
    return not (_NAME.match(line) or len(line) < 60 and _CONTACT.search(line) and not _NOTICE.search(line)) and not _closing(line, False)


def _signs(line: str) -> bool:
    """A line as signatures have it; a sentence is none."""
    t = line.strip()
    return len(t) <= SIGNATURE_CHARS and not (t[-1] in ".!?" and len(t.split()) > 6) and not t.endswith(",")


def _sign_block(lines: list[str], block: list[int]) -> bool:
    """A name followed by a few short lines up to the end of the text, one of which may tell a contact."""
    if len(block) > BLOCK_LINES or len(block) < 2 or block[-1] - block[0] > len(block) + 1:
        return False
    rest = [lines[k].strip() for k in block[1:]]
    return all(_signs(t) for t in rest) and (any(_CONTACT.search(t) for t in rest) or all(len(t.split()) <= 6 and t[0].isupper() for t in rest))


def not_own(text: str, recurring: frozenset[str]) -> list[int]:
    """The numbers of the non-blank lines that the sender did not newly write, by layout and endings."""
    lines = [x.strip() for x in text.split("\n")]
    taken = quoted(lines)
    tail = endings(lines, taken, recurring)
    return [i for i, x in enumerate(lines) if x.strip() and (taken[i] or tail[i])]


def tail_sentences(text: str) -> list[str]:
    """Sentences that follow a closing formula in what the layout leaves to the sender."""
    lines = [x.strip() for x in text.split("\n")]
    taken = quoted(lines)
    out: list[str] = []
    for i, j in _segments(lines, taken):
        closed = next((k for k in range(j - 1, i, -1) if lines[k].strip().rstrip(",.!").lower().replace("’", "'") in CLOSINGS), None)
        if closed is not None:
            for a, b in _paragraphs(lines, closed + 1, j):
                out.extend(sentences(" ".join(lines[a:b])))
    return list(dict.fromkeys(out))


def bodies(emails: DataFrame) -> DataFrame:
    """(record_id, att_pos, text, thread, at, sender) of the e-mail bodies."""
    body = F.filter(F.transform(F.coalesce("attachments", F.array()), lambda a, i: F.struct(i.cast("long").alias("att_pos"), a["is_email_body"].alias("body"), a["extracted_text"].alias("text"))), lambda a: F.coalesce(a["body"], F.lit(False)) & (F.length(a["text"]) > 0))
    subject = F.lower(F.regexp_replace(F.coalesce("subject", F.lit("")), r"(?i)^\W*(?:(?:re|fwd?|tr|réf|ref|rép|aw|wg)\s*[:.]+\s*:?\s*)*", ""))
    who = lambda c: F.lower(F.coalesce(c["address"], c["name"], c["raw"], F.lit("")))
    pair = F.array_sort(F.array(who(F.col("author")), who(F.get(F.col("targets"), F.lit(0)))))
    thread = F.xxhash64(subject, pair)
    at = F.coalesce(F.try_to_timestamp("expedition_date"), F.col("delivered_at"))
    return emails.select(F.col("record_id").cast("long").alias("record_id"), F.explode(body).alias("b"), thread.alias("thread"), at.alias("at"), F.lower(F.trim(F.coalesce("author.address", F.lit("")))).alias("sender")).select("record_id", "b.att_pos", "b.text", "thread", "at", "sender")


def places(texts: DataFrame) -> DataFrame:
    """(record_id, att_pos, thread, at, sender, key) of the bodies, without their texts, written once."""
    return persisted(texts.select("record_id", "att_pos", "thread", "at", "sender", F.md5("text").alias("key")), "bodies")


def learn_endings(texts: DataFrame) -> tuple[frozenset[str], DataFrame]:
    """Sentences that end ``ENDING_SHARE`` of all messages, a list bounded by that share; (sender, endings) of the
    other ones that end this share of the messages of the sender or of the sender's domain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Counter = Counter()

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in c], pa.string()), pa.array([k[1] for k in c], pa.string()), pa.array(list(c.values()), pa.int64())], names=["sender", "sentence", "n"])

        for batch in batches:
            for who, t in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                c.update((who, x) for x in tail_sentences(t))
                c[who, ""] += 1
            if len(c) > FLUSH:
                yield told()
                c.clear()
        if c:
            yield told()

    domain = F.when(F.col("sender").contains("@"), F.substring_index("sender", "@", -1))
    sums = persisted(texts.select("sender", "text").mapInArrow(run, "sender string, sentence string, n long").groupBy("sender", "sentence").agg(F.sum("n").alias("n")).withColumn("domain", domain), "endings")
    total = sums.where("sentence = ''").agg(F.sum("n")).first()[0] or 0
    enough = lambda of: F.col("n") >= F.greatest(F.lit(float(ENDING_LEAST)), F.lit(ENDING_SHARE) * of)
    everyone = sums.where("sentence != ''").groupBy("sentence").agg(F.sum("n").alias("n")).where(enough(F.lit(total))).select("sentence")

    def of(key: str) -> DataFrame:
        counted = sums.where(F.col(key) != "").groupBy(key, "sentence").agg(F.sum("n").alias("n"))
        totals = counted.where("sentence = ''").select(key, F.col("n").alias("of"))
        return counted.where(F.col("sentence") != "").where(F.col("n") >= ENDING_LEAST).join(totals, key).where(enough(F.col("of"))).select(key, "sentence")

    senders = sums.where("sentence = '' and sender != ''").select("sender", "domain")
    rows = everyone.collect()
    theirs = of("sender").unionByName(senders.join(of("domain"), "domain").select("sender", "sentence")).join(everyone, "sentence", "left_anti")
    return frozenset(r["sentence"] for r in rows), persisted(theirs.groupBy("sender").agg(F.collect_set("sentence").alias("endings")), "theirs")


def ending_lines(text: str) -> Iterator[tuple[int, int, int, str]]:
    """(part, place, line number, words) of the lines that may be an ending, part by part of what the layout leaves.

    Behind a closing formula, and a bare given name right below it, every line may, place -1.  A part without a closing
    formula is told from its end, place 0 on.
    """
    lines = [x.strip() for x in text.split("\n")]
    for part, (i, j) in enumerate(_segments(lines, quoted(lines))):
        full = [k for k in range(i, j) if lines[k]]
        closed = next((n for n in range(len(full) - 1, -1, -1) if _closing(lines[full[n]], n == 0 and len(full) > 2)), None)
        if closed is None:
            spoken = [(k, w) for k in reversed(full) if (w := " ".join(words(lines[k])))]
            yield from ((part, place, k, w) for place, (k, w) in enumerate(spoken))
            continue
        below = full[closed + 1 :]
        if below and below[0] == full[closed] + 1 and _GIVEN.match(lines[below[0]]) and not _NAME.match(lines[below[0]]):
            below = below[1:]
        yield from ((part, -1, k, w) for k in below if (w := " ".join(words(lines[k]))))


def sender_endings(texts: DataFrame, placed: DataFrame | None = None) -> DataFrame:
    """(record_id, att_pos, line_no) of the lines that recur at the end of different messages of one sender.

    Lines travel as hashes under (sender, line), never whole texts, and are counted before they meet; a part without a
    closing formula is an ending as far as its lines, from the end upwards, recur without a gap.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list[int]] = [[] for _ in range(8)]
            for sender, own, r, a, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for part, place, k, w in ending_lines(t):
                    for c, x in zip(cols, (sender, _line_hash(w), own, r, a, part, place, k), strict=True):
                        c.append(x)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["sender", "line", "own", "record_id", "att_pos", "part", "place", "line_no"])

    asked = texts.where("sender != ''").select(F.xxhash64("sender").alias("sender"), F.xxhash64("text").alias("own"), "record_id", "att_pos", "text")
    totals = (placed or places(texts)).where("sender != ''").groupBy(F.xxhash64("sender").alias("sender")).agg(F.countDistinct("key").alias("messages"))
    lines = persisted(asked.mapInArrow(run, "sender long, line long, own long, record_id long, att_pos long, part int, place int, line_no long"), "ending-lines")
    counted = lines.groupBy("sender", "line").agg(F.countDistinct("own").alias("n")).where(F.col("n") >= LINE_CLOSED)
    recurring = counted.join(totals, "sender").where(F.col("n") >= F.lit(LINE_SHARE) * F.col("messages")).select("sender", "line", "n")
    met = lines.join(recurring, ["sender", "line"])
    closed = met.where("place < 0").select("record_id", "att_pos", "line_no")
    ends = met.where((F.col("place") >= 0) & (F.col("n") >= LINE_OPEN)).groupBy("record_id", "att_pos", "part").agg(F.array_sort(F.collect_set(F.struct("place", "line_no"))).alias("found"))
    unbroken = F.filter("found", lambda x, i: x["place"] == i)
    return closed.unionByName(ends.select("record_id", "att_pos", F.explode(unbroken).alias("x")).select("record_id", "att_pos", "x.line_no"))


class WordAutomaton:
    """Generalised suffix automaton over the words of the messages added so far."""

    def __init__(self):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.len = [-1], [0]

    def add(self, tokens: list[str]) -> None:
        nxt, link, length = self.next, self.link, self.len

        def split(p: int, q: int, t: str) -> int:
            nxt.append(dict(nxt[q]))
            link.append(link[q])
            length.append(length[p] + 1)
            clone = len(length) - 1
            link[q] = clone
            while p >= 0 and nxt[p].get(t) == q:
                nxt[p][t] = clone
                p = link[p]
            return clone

        last = 0
        for t in tokens:
            q = nxt[last].get(t)
            if q is not None:
                last = q if length[q] == length[last] + 1 else split(last, q, t)
                continue
            nxt.append({})
            link.append(0)
            length.append(length[last] + 1)
            cur, p = len(length) - 1, last
            while p >= 0 and t not in nxt[p]:
                nxt[p][t] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][t]
                link[cur] = q if length[q] == length[p] + 1 else split(p, q, t)
            last = cur

    def inherited(self, tokens: list[str], least: int) -> list[bool]:
        """Words inside matches of at least ``least`` words."""
        out = [False] * len(tokens)
        v = n = 0
        for i, t in enumerate(tokens):
            while v and t not in self.next[v]:
                v = self.link[v]
                n = self.len[v]
            if t in self.next[v]:
                v = self.next[v][t]
                n += 1
            else:
                n = 0
            if n >= least:
                k = i
                while k > i - n and not out[k]:
                    out[k] = True
                    k -= 1
        return out


def _line_hash(line: str) -> int:
    return int.from_bytes(hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


@lru_cache(100_000)
def _word_hash(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def sequences(tokens: list[str], least: int = INHERITED) -> np.ndarray:
    """A hash of each ``least`` successive words."""
    n = len(tokens) - least + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    if n > 0:
        h = np.array([_word_hash(t) for t in tokens], dtype=np.uint64)
        for k in range(least):
            out = out * _STEP + h[k : k + n]
    return out.view(np.int64)


def _text_words(text: str) -> list[str]:
    return words("\n".join(map(_bare, text.split("\n"))))


def inherited_lines(text: str, automaton: WordAutomaton, least: int = INHERITED, known: frozenset[int] = frozenset()) -> list[int]:
    """Lines inside matches with the automaton or with the ``known`` sequences of ``least`` words."""
    lines = text.split("\n")
    tokens: list[str] = []
    spans = []
    for x in lines:
        w = words(_bare(x))
        spans.append((len(tokens), len(tokens) + len(w)))
        tokens.extend(w)
    marks = automaton.inherited(tokens, least)
    for i, g in enumerate(sequences(tokens, least).tolist() if known else []):
        if g in known:
            marks[i : i + least] = [True] * least
    return [i for i, (a, b) in enumerate(spans) if b > a and all(marks[a:b])]


def _run_lines(group: pd.DataFrame, known: frozenset[int]) -> pd.DataFrame:
    """Lines of a run's messages inherited from earlier ones of the run or, by ``known``, of earlier runs."""
    group = group.sort_values(["place", "record_id", "att_pos"])
    automaton, seen, rows = WordAutomaton(), set(), []
    for record, pos, text in zip(group["record_id"], group["att_pos"], group["text"], strict=True):
        if text in seen:
            continue  # copies inherit from the same messages and are met again by their text
        if seen or known:
            rows.extend((record, pos, i) for i in inherited_lines(text, automaton, known=known))
        automaton.add(_text_words(text))
        seen.add(text)
    return pd.DataFrame(rows, columns=["record_id", "att_pos", "line_no"]).astype("int64")


def _thread_run(group: pd.DataFrame) -> pd.DataFrame:
    return _run_lines(group, frozenset())


def _later_run(group: pd.DataFrame, before: pd.DataFrame) -> pd.DataFrame:
    return _run_lines(group, frozenset(before["seq"].tolist()))


def _from_earlier_runs(whole: DataFrame) -> DataFrame:
    """(thread, run, seq) of the word sequences of a run that an earlier run of its thread holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for thread, r, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = np.unique(sequences(_text_words(text)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), thread)), pa.array(np.full(len(found), r)), pa.array(found)], names=["thread", "run", "seq"])

    held = persisted(whole.select("thread", "run", "text").mapInArrow(run, "thread long, run long, seq long").distinct(), "sequences")
    first = held.groupBy("thread", "seq").agg(F.min("run").alias("first"), F.max("run").alias("last")).where("last > first").select("thread", "seq", "first")
    return held.join(first, ["thread", "seq"]).where("run > first").select("thread", "run", "seq")


def inherited(texts: DataFrame, placed: DataFrame | None = None) -> DataFrame:
    """(record_id, att_pos, line_no) of lines inherited from earlier messages of their thread.

    The place of a message in its thread comes from a range-partitioned sort with
    offsets for each partition, so a thread that holds a third of all messages is
    sorted by many tasks; it is then handled in runs of ``RUN`` messages, which meet
    all earlier runs through the word sequences that they share.
    """
    once = (placed or places(texts)).groupBy("thread", "key").agg(F.min(F.struct("at", "record_id", "att_pos")).alias("m"))
    several = once.groupBy("thread").agg(F.count("*").alias("n")).where("n > 1")
    heads = once.join(several, "thread").select("thread", "m.at", "m.record_id", "m.att_pos", (F.col("n") > RUN).alias("long"))
    ranged = persisted(heads.repartitionByRange("thread", "at", "record_id").sortWithinPartitions("thread", "at", "record_id").withColumn("part", F.spark_partition_id()), "threads")
    sizes = ranged.groupBy("thread", "part").agg(F.count("*").alias("n"))
    before = sizes.withColumn("offset", F.coalesce(F.sum("n").over(W.partitionBy("thread").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("n")
    numbered = ranged.withColumn("k", F.row_number().over(W.partitionBy("part", "thread").orderBy("at", "record_id", "att_pos"))).join(before, ["thread", "part"]).withColumn("place", F.col("offset") + F.col("k") - 1)
    runs = numbered.select("thread", "record_id", "att_pos", "place", "long", F.floor(F.col("place") / RUN).cast("long").alias("run"))
    whole = runs.join(texts.select("record_id", "att_pos", "text"), ["record_id", "att_pos"])
    schema = "record_id long, att_pos long, line_no long"
    if ranged.where("long").isEmpty():
        return whole.groupBy("thread", "run").applyInPandas(_thread_run, schema)
    known = _from_earlier_runs(whole.where("long"))
    return whole.groupBy("thread", "run").cogroup(known.groupBy("thread", "run")).applyInPandas(_later_run, schema)


def foreign_lines(emails: DataFrame) -> DataFrame:
    """(record_id, att_pos, line_no) of the non-blank lines that the sender did not newly write."""
    texts = bodies(emails)
    placed = places(texts)
    everyone, theirs = learn_endings(texts)
    recurring = emails.sparkSession.sparkContext.broadcast(everyone)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = recurring.value
        for batch in batches:
            rec, pos, no = [], [], []
            for r, a, t, more in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = not_own(t, known.union(more) if more else known)
                rec.extend([r] * len(found))
                pos.extend([a] * len(found))
                no.extend(found)
            yield pa.RecordBatch.from_arrays([pa.array(rec, pa.int64()), pa.array(pos, pa.int64()), pa.array(no, pa.int64())], names=["record_id", "att_pos", "line_no"])

    by_layout = texts.join(theirs, "sender", "left").select("record_id", "att_pos", "text", "endings").mapInArrow(run, "record_id long, att_pos long, line_no long")
    # heads of threads with equal texts answer for their copies
    keyed = placed.select("record_id", "att_pos", "thread", "key")
    found = inherited(texts, placed)
    heads = found.join(keyed, ["record_id", "att_pos"]).select("thread", "key", "line_no")
    passed_on = keyed.join(heads, ["thread", "key"]).select("record_id", "att_pos", "line_no")
    return by_layout.unionByName(passed_on).unionByName(sender_endings(texts, placed)).distinct()


def own_texts(emails: DataFrame) -> DataFrame:
    """(record_id, att_pos, text): each body reduced to what its sender wrote."""
    marked = foreign_lines(emails).groupBy("record_id", "att_pos").agg(F.collect_list("line_no").alias("foreign"))
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(F.regexp_replace(x, "\r$", "").alias("x"), i.cast("long").alias("i")))
    kept = F.array_join(F.transform(F.filter(lines, lambda s: ~F.array_contains(F.coalesce("foreign", F.array().cast("array<bigint>")), s["i"])), lambda s: s["x"]), "\n")
    clean = F.regexp_replace(F.regexp_replace(kept, r"\n\s*\n(?:\s*\n)+", "\n\n"), r"^\s+|\s+$", "")
    return bodies(emails).join(marked, ["record_id", "att_pos"], "left").select("record_id", "att_pos", clean.alias("text"))
