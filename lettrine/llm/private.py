"""Personal information in free text: found, and replaced by typed placeholders.

A transducer writes each text in a plain form (look-alike letters, full-width forms,
``[at]`` and ``(dot)``, spelled digits) and keeps, for every character of it, the
source characters it came from.  E-mail addresses, phone numbers, identity numbers,
street addresses and names are detected in the plain form; their spans are mapped
back, so what is reported and replaced are exactly the characters of the text.

Given names are learned from the contacts of the corpus: words that pair with several
different other words and mostly stand before them, or with very many in any order.
The words before and after names are learned from the texts: what stands where known
given names with surnames stand decides where names in lower case, surnames before
given names and initials may begin.  The lists are broadcast; the texts are not shuffled.

Defined results: null and empty texts hold nothing and come out as they are; of
overlapping finds the earlier kind in the order id_number, email, phone,
street_address, person_name holds; every different value of a text is one row;
repeated rows count once; texts of any length are read whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettrine.llm.base import folded, persisted

KINDS = ("id_number", "email", "phone", "street_address", "person_name")
PLACEHOLDERS = {"id_number": "[ID_NUMBER]", "email": "[EMAIL]", "phone": "[PHONE]", "street_address": "[ADDRESS]", "person_name": "[NAME]"}
#: A word is a given name if it pairs with so many different words and stands first in as many pairs as last, or holds this share of all pairs.
PAIRS_LEAST, PAIRS_SHARE = 5, 0.0003
#: Two words are a context of names if so many full names stand behind them, and this share of the capitalised words there.
CONTEXT_LEAST, CONTEXT_SHARE = 5, 0.25
#: A word follows names if it stands behind so many full names, and behind this share of all.
AFTER_LEAST, AFTER_SHARE = 5, 0.003

# ---------------------------------------------------------------- plain form

#: Letters that look like Latin ones.
_LOOKALIKE = dict(zip("АВЕКМНОРСТУХаеорсухіјѕԁɡΑΒΕΖΗΙΚΜΝΟΡΤΥΧοναιρ", "ABEKMHOPCTYXaeopcyxijsdgABEZHIKMNOPTYXovaip", strict=True))
_DIGIT_WORDS = {
    "zéro": "0", "zero": "0", "oh": "0", "un": "1", "une": "1", "one": "1", "deux": "2", "two": "2", "trois": "3", "three": "3", "quatre": "4", "four": "4",
    "cinq": "5", "five": "5", "six": "6", "sept": "7", "seven": "7", "huit": "8", "eight": "8", "neuf": "9", "nine": "9",
}
_WORD_RUN = re.compile(r"\b(?:%s)(?:[ ,.-]+(?:%s)\b){5,}" % ("|".join(_DIGIT_WORDS), "|".join(_DIGIT_WORDS)), re.I)
_DIGIT_WORD = re.compile("|".join(_DIGIT_WORDS), re.I)
_AT = re.compile(r"(?<=[\w.+-])\s?[\[({<]\s?(?:at|arobase|@|a)\s?[\])}>]\s?(?=[\w-]+(?:\.|\s?[\[({]))|(?<=\w) (?:@|arobase|at) (?=[\w-]+(?:\.[\w-]+)*\.[a-z]{2,}\b|[\w-]+ (?:dot|point) )|(?<=\w)(?: @|@ )(?=[\w-]+\.[a-z]{2,})", re.I)
_DOT = re.compile(r"(?<=\w)\s?[\[({<]\s?(?:dot|point|\.)\s?[\])}>]\s?(?=\w)", re.I)
_ODD = re.compile(r"[Ͱ-ӿԁɡ​-‏⁠﻿！-～]")
#: Every match of ``_AT`` and ``_DOT`` holds a match of this.
_BRACKETED = re.compile(r"[\[({<]\s?(?:at|arobase|@|a|dot|point|\.)\s?[\])}>]| @|@ | arobase | at ", re.I)
#: Every match of ``_WORD_RUN`` holds, between separators, one of these words or two successive ones of the others.
_TELLING = frozenset(_DIGIT_WORDS) - {"un", "une", "one", "oh"}
_ONES = re.compile(r"[ ,.-](?:une?|one|oh)[ ,.-]+(?:une?|one|oh)[ ,.-]")


def _digit_form(text: str) -> str:
    """Text with the letters that patterns without case take for those of digit words."""
    return text.lower() if text.isascii() else text.casefold().replace("\u0307", "").replace("ı", "i")


def _spells_digits(text: str) -> bool:
    form = _digit_form(text)
    apart = form.replace(",", " ").replace(".", " ").replace("-", " ").split()
    return (not _TELLING.isdisjoint(apart) or bool(_ONES.search(form))) and bool(_WORD_RUN.search(text))


def _disguised(text: str) -> bool:
    """Whether the plain form may differ from the text."""
    if not text.isascii() and _ODD.search(text):
        return True
    if _BRACKETED.search(text) and (_AT.search(text) or _DOT.search(text)):
        return True
    return _spells_digits(text)


def plain(text: str) -> tuple[str, list[tuple[int, int]] | None]:
    """(plain form, source span of each of its characters); no spans if the text is plain already."""
    if not _disguised(text):
        return text, None
    swaps: list[tuple[int, int, str]] = [(m.start(), m.end(), "@") for m in _AT.finditer(text)]
    swaps += [(m.start(), m.end(), ".") for m in _DOT.finditer(text)]
    for m in _WORD_RUN.finditer(text):
        digits = "".join(_DIGIT_WORDS[_digit_form(d[0])] for d in _DIGIT_WORD.finditer(m[0]))
        swaps.append((m.start(), m.end(), digits))
    swaps.sort()
    out: list[str] = []
    spans: list[tuple[int, int]] = []
    i = 0
    for a, b, new in [*swaps, (len(text), len(text), "")]:
        if a < i:
            continue
        while i < a:
            ch = text[i]
            code = ord(ch)
            if ch in "​‌‍‎‏⁠﻿":
                i += 1
                continue
            if 0xFF01 <= code <= 0xFF5E:
                ch = chr(code - 0xFEE0)
            out.append(_LOOKALIKE.get(ch, ch) if code > 0x36F else ch)
            spans.append((i, i + 1))
            i += 1
        out.append(new)
        spans.extend([(a, b)] * len(new))
        i = max(i, b)
    return "".join(out), spans


# ---------------------------------------------------------------- identifiers

_WS = r"(?:[ \t\xa0]|\r?\n[>| \t]*)"
_DOMAIN = re.compile(r"[A-Za-z0-9À-ÿ](?:[\w-]*\w)?(?:\.[\w](?:[\w-]*\w)?)+")
_IDS = re.compile(
    r"(?<![\w./-])(?:"
    r"[12378](?P<s>[ .-]?)\d\d(?P=s)\d\d(?P=s)(?:\d\d|2[AB])(?P=s)\d{3}(?P=s)\d{3}(?:(?P=s)|[ .]?)\d\d"  # social security
    r"|[A-CEGHJ-PQ-TW-Z][A-Z] ?\d\d ?\d\d ?\d\d ?[A-Z]"  # national insurance
    r"|ID-\d{3}-\d\d-\d{4}|\d\d[A-Z]{2}\d{5}|\d{6}[A-Z]\d{5}"  # cards and passports
    r"|\d{3}-\d\d-\d{4}|\d{8}[A-HJ-NP-TV-Z]"
    r")(?![\w]|[.-]\d)"
)
_PHONE = re.compile(
    r"(?<![\w./+-])(?:"
    r"(?:\+|00)33[ .-]?(?:\(0\)[ .-]?)?[1-9](?:[ .-]?\d\d){4}"
    r"|0[1-9](?P<p>[ .-]?)\d\d(?:(?P=p)\d\d){3}"
    r"|(?:\+|00)44[ .-]?(?:\(0\)[ .-]?)?\d{2,4}[ .-]?\d{3,4}[ .-]?\d{3,4}"
    r"|\(0\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}|0\d{4}[ .-]\d{6}|02\d[ .-]\d{4}[ .-]\d{4}|01\d1[ .-]\d{3}[ .-]\d{4}|0\d{3}[ .-]\d{3}[ .-]\d{4}"
    r"|(?:(?:\+|00)1[ .-]?)?(?:\([2-9]\d\d\)[ .-]?|[2-9]\d\d[.-])\d{3}[.-]\d{4}|(?:\+|00)1[ .-][2-9]\d\d[ .-]\d{3}[ .-]\d{4}"
    r"|\+(?!33|44|1\b)\d{1,3}(?:[ .-]?\(?\d{1,4}\)?){2,5}"
    r")(?![\w]|[.,/-]\d)"
)
_CAP = r"[A-ZÀ-ÖØ-Þ][\w'’-]*"
_LINK = r"(?:de|du|des|la|le|les|lès|sur|sous|en|et|aux|upon|on|the|of)"
_TOWN = rf"(?:(?:La|Le|Les|Saint|Sainte|St\.?|Upper|Lower|Little|Great|North|South|East|West|New|Old|Port|Mont|Bourg){_WS})?{_CAP}(?:(?: {_LINK}){{1,2}} {_CAP}| {_CAP}(?=[ \t]*(?:[,.;)]|\r?\n|$)))?"
_ROAD_FR = r"rue|avenue|av\.|boulevard|bd|chemin|impasse|place|quai|cours|all[ée]e|route|square|passage|ruelle|sentier|mont[ée]e|esplanade|faubourg|venelle|promenade"
_UNIT = rf"(?:(?:Flat|Apt|Apartment|Unit|Suite|Appartement|Appt?|B[âa]t(?:iment)?|Porte|Esc(?:alier)?)\.?{_WS}?(?:n°{_WS}?)?\w{{1,4}}{_WS}?,?{_WS}(?:[-–]{_WS})?)?"
_ADDRESS = re.compile(
    rf"(?<![\w/.,-])(?:{_UNIT}\d{{1,4}}(?:{_WS}?(?:bis|ter|quater|[A-D])\b)?,?[ \t\xa0]+(?:{_ROAD_FR})\b{_WS}[\w'’.-]+(?:{_WS}[\w'’.-]+){{0,5}}?(?:{_WS}?[,–-]{_WS}?|{_WS})\d{{5}}(?:{_WS}{_TOWN})?"
    rf"|{_UNIT}\d{{1,4}}(?:{_WS}?(?:bis|ter|quater|[A-D])\b)?,?[ \t\xa0]+(?:{_ROAD_FR})\b(?:{_WS}(?:de|du|des|la|le|les|l['’]|d['’]))*{_WS}?{_CAP}(?:(?:{_WS}|-)(?:{_CAP}|(?:de|du|des|la|le|les|sur|en)\b))*(?:{_WS}?[,–-]{_WS}?{_TOWN})?"
    rf"|{_UNIT}\d{{1,4}}[A-Da-d]?,?[ \t\xa0]+(?:{_CAP}[ \t\xa0]+){{1,3}}(?:Street|St\.?|Avenue|Ave\.?|Road|Rd\.?|Drive|Dr\.?|Lane|Ln\.?|Close|Row|Court|Square|Place|Terrace|Way|Crescent|Gardens|Grove|Hill|Mews|Walk|Park|View|Rise|Boulevard)\b(?:,{_WS}{_TOWN}(?:,?{_WS}[A-Z]{{1,2}}\d[A-Z\d]?{_WS}?\d[A-Z]{{2}}|,{_WS}[A-Z]{{2}}{_WS}\d{{5}})?)?"
    r")"
)
_ROAD_HINT = re.compile(rf"\d(?:{_WS}?(?:bis|ter|quater|[A-Da-d])\b)?,?[ \t\xa0]+(?:(?:{_ROAD_FR})\b|[A-Z])")

# ---------------------------------------------------------------- names

#: Titles before names, and words that greet.
TITLES = frozenset("M. Mr Mr. Mrs Mrs. Ms Ms. Mme Mme. Mlle Dr Dr. Me Maître Monsieur Madame Mademoiselle Docteur Pr Pr. Professeur Sir Miss MM.".split())
GREETINGS = frozenset("bonjour bonsoir cher chère dear hi hello salut".split())
#: Words of firms and places, after or before a name.
_NOT_PERSON = frozenset(
    "sa sas sarl sci snc gmbh ltd limited plc llc inc immobilier habitat conseil assurances travaux notaires expertise gestion patrimoine logistique energie etudes groupe group lettings estates house wing court road street avenue close lane drive row hall tower "
    "school bank services holdings partners associates company agency agence cabinet residence square rue place boulevard allee chemin impasse quai cours route pavillon lycee college hopital hospital institute foundation fondation theatre".split()
)
#: Capitalised words that begin sentences or lines beside names.
_NOT_NAME = frozenset(
    "bonjour bonsoir cher chere dear hi hello salut good le la les l un une des de du d a au aux en et ou the an of to from on in at by for with subject objet envoye sent date cc madame monsieur signature signing copie copy merci please vous you nous we il elle ils "
    "tel phone mail file dossier lundi mardi mercredi jeudi vendredi samedi dimanche monday tuesday wednesday thursday friday saturday sunday janvier fevrier mars avril mai juin juillet aout septembre octobre novembre decembre january february march april may june july august "
    "september october november december cordialement best regards kind many thanks yours sincerely bien salutations cdlt bonne notre sauf par pour selon sous sans suite apres avant des malgre faute comme since after before as if our all page note piece identity document".split()
)
_CAPITAL = re.compile(r"(?<![\w@.'’+-])[A-ZÀ-ÖØ-Þ](?:\.-?[A-ZÀ-Þ]\.|[\w'’-]*\.?)")
#: Words in lower case, and marks and words before a name.
_LOWER = re.compile(r"(?<![\w@.'’-])[a-zà-ÿ][a-zà-ÿ'’-]+(?![\w@'’-])")
_BEFORE = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[:(,]")
_AFTER = re.compile(r"\s*([^\W\d_]+|[^\w\s])?")
#: A display name before an address in brackets has at most so many characters.
SHOWN_CHARS = 90
_INITIALS = re.compile(r"[A-ZÀ-Þ]\.(?:-?[A-ZÀ-Þ]\.)?")
_SHOWN_BEFORE = re.compile(r"(?:^|[\n:>|]|\d,|\bà|\bto|,)[ \t>|*]*\"?((?:[^\W\d_][\w'’.-]*[ \t]+){1,3}(?:[^\W\d_][\w'’.-]*))\"?[ \t]*$")


_ONE_GAP = re.compile(_WS)
SLOTS = 1 << 20


def slot(context: str) -> int:
    return zlib.crc32(context.encode("utf-8", "surrogatepass")) & (SLOTS - 1)


def context_before(text: str, a: int) -> str | None:
    """The two words or marks before a place, in lower case; None if no two stand there, or no blank after them."""
    pre = text[max(0, a - 48) : a]
    stripped = pre.rstrip(" \t\r\n>|")
    if not stripped or stripped == pre or not (stripped[-1].isalpha() or stripped[-1] in ":(,"):
        return None
    tokens = _BEFORE.findall(stripped)[-2:]
    return " ".join(tokens).lower() if len(tokens) == 2 else None


class Names:
    """Detector of personal names with a list of given names, slots of the words before names and words after names."""

    def __init__(self, given: frozenset[str], contexts: frozenset[int] = frozenset(), after: frozenset[str] = frozenset()):
        self.given, self.contexts, self.after = given, contexts, after
        self._kinds: dict[str, str] = {}
        self._lower: dict[str, bool] = {}

    def certain(self, text: str) -> Iterator[tuple[int, int, bool]]:
        """(begin, end, whether it is a given name with a surname) of each capitalised word or name behind a blank."""
        found = [(m.start(), m.end(), m[0]) for m in _CAPITAL.finditer(text)]
        for i, (a, b, token) in enumerate(found):
            sure = False
            if i + 1 < len(found) and self.kind(token) == "g" and not token.endswith("."):
                c, d, nxt = found[i + 1]
                if text[b:c] in (" ", "\n") and self.kind(nxt) == "" and len(nxt.strip(".")) > 1:
                    sure, b = True, d - nxt.endswith(".")
            yield a, b, sure

    def kind(self, token: str) -> str:
        """g(iven), t(itle), i(nitial), o(rganisation or place), x (never part of a name) or '' of a capitalised word."""
        k = self._kinds.get(token)
        if k is None:
            f = folded(token).strip(".'’")
            if token in TITLES:
                k = "t"
            elif _INITIALS.fullmatch(token):
                k = "i"
            elif f in self.given:
                k = "g"
            elif f in _NOT_PERSON:
                k = "o"
            elif f in _NOT_NAME or f[:2] in ("l'", "d'", "l’", "d’", "j'", "n'", "s'", "c'", "m'") or f.startswith(("qu'", "qu’")):
                k = "x"
            else:
                k = ""
            if len(self._kinds) > 300_000:
                self._kinds.clear()
            self._kinds[token] = k
        return k

    @staticmethod
    def _gap(text: str, a: int, b: int) -> bool:
        """Only white space between two words; a line end only in a long line, where it is a wrapping."""
        between = text[a:b]
        if not between or len(between) > 12:
            return False
        if "\n" not in between:
            return between.isspace()
        start = text.rfind("\n", 0, a) + 1
        return between.count("\n") == 1 and not between.strip("\r\n>| \t") and a - start >= 45

    def find(self, text: str) -> Iterator[tuple[int, int]]:
        words = [(m.start(), m.end(), m[0]) for m in _CAPITAL.finditer(text)]
        n = len(words)
        done = -1
        for i, (a, b, token) in enumerate(words):
            if a < done:
                continue
            k = self.kind(token)
            if k == "t" and i + 1 < n and self._gap(text, b, words[i + 1][0]):
                c, d, nxt = words[i + 1]
                if self.kind(nxt) == "" and nxt.strip(".") and len(nxt.strip(".")) > 2:
                    d -= nxt.endswith(".")
                    if i + 2 < n and self.kind(words[i + 2][2]) == "g" and not nxt.endswith(".") and self._gap(text, d, words[i + 2][0]):
                        d = words[i + 2][1] - words[i + 2][2].endswith(".")
                    done = d
                    yield c, d
                continue
            if k == "i":
                if i + 1 < n and text[b : words[i + 1][0]] == " " and self.kind(words[i + 1][2]) == "" and len(words[i + 1][2].strip(".")) > 3 and self._starts(text, a):
                    done = words[i + 1][1] - words[i + 1][2].endswith(".")
                    yield a, done
                elif i and text[words[i - 1][1] : a] == " " and self.kind(words[i - 1][2]) == "" and len(words[i - 1][2]) > 3 and self._starts(text, words[i - 1][0]):
                    done = b
                    yield words[i - 1][0], b
                continue
            if k != "g":
                continue
            end = b - token.endswith(".")
            if text[end : end + 1] == "@":
                continue
            before = words[i - 1] if i and (not words[i - 1][2].endswith(".") or self.kind(words[i - 1][2]) in "ti") and self._gap(text, words[i - 1][1], a) else None
            after = words[i + 1] if not token.endswith(".") and i + 1 < n and self._gap(text, end, words[i + 1][0]) else None
            if before and self.kind(before[2]) == "o" or after and self.kind(after[2]) == "o" or after and i + 2 < n and self._gap(text, after[1], words[i + 2][0]) and self.kind(words[i + 2][2]) == "o":
                continue
            if self._place_before(text, a):
                continue
            if after and self.kind(after[2]) in ("", "g") and len(after[2].strip(".")) > 1:
                stop = after[1] - after[2].endswith(".")
                if text[stop : stop + 1] != "@":
                    done = stop
                    yield a, stop
                    continue
            if before and self.kind(before[2]) == "" and len(before[2].strip(".,")) > 2 and not before[2].endswith("."):
                surname = before[2]
                if surname.isupper() or self._alone(text, before[0], end) or self._told(text, before[0]):
                    done = end
                    yield before[0], end
                    continue
            if self._alone(text, a, end) or before and folded(before[2]) in GREETINGS:
                done = end
                yield a, end

    @staticmethod
    def _place_before(text: str, a: int) -> bool:
        word = (text[max(0, a - 16) : a].rsplit(None, 1)[-1:] or [""])[0]
        if not word or word[-1] in ".!?:;,)" or "\n" in text[max(0, a - 2) : a]:
            return False
        return folded(word).strip("('’") in _NOT_PERSON

    @staticmethod
    def _alone(text: str, a: int, b: int) -> bool:
        """The words stand alone on their line, but for quote marks and a comma."""
        start = text.rfind("\n", 0, a) + 1
        stop = text.find("\n", b)
        rest = text[b : len(text) if stop < 0 else stop].strip()
        return not text[start:a].strip(" >|\t") and rest in ("", ",", ".")

    def _starts(self, text: str, a: int) -> bool:
        """A name may begin here: after words that name someone, at a line or sentence start."""
        start = text.rfind("\n", 0, a) + 1
        return not text[start:a].strip(" >|\t") or text[max(0, a - 2) : a] == ". " or self._told(text, a)

    def _told(self, text: str, a: int) -> bool:
        """Behind words after which names mostly stand in this corpus, or a colon."""
        context = context_before(text, a)
        return context is not None and (context.endswith(" :") or slot(context) in self.contexts)

    def _is_given(self, word: str) -> bool:
        known = self._lower.get(word)
        if known is None:
            if len(self._lower) > 300_000:
                self._lower.clear()
            known = self._lower[word] = len(word) > 2 and folded(word) in self.given
        return known

    def in_lower_case(self, text: str) -> Iterator[tuple[int, int]]:
        """Two words in lower case, one of them a given name, where a name may begin and end."""
        found = [(m.start(), m.end(), m[0]) for m in _LOWER.finditer(text)]
        for (a, b, one), (c, d, two) in zip(found, found[1:], strict=False):
            if len(two) < 3 or not (self._is_given(one) or self._is_given(two)) or not _ONE_GAP.fullmatch(text, b, c):
                continue
            ahead = text[max(0, a - 8) : a].rstrip(" \t>|")
            if ahead and ahead[-1] not in ":,.\n" and not self._told(text, a):
                continue
            m = _AFTER.match(text, d)
            if m[1] is None or "\n" in m[0] or m[1] in ".,;)<([" or m[1].lower() in self.after:
                yield a, d

    def others(self, text: str, emails: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
        """Names in lower case, and before an e-mail address in brackets."""
        yield from self.in_lower_case(text)
        for a, _ in emails:
            if a and text[a - 1] in "<([":
                m = _SHOWN_BEFORE.search(text, max(0, a - SHOWN_CHARS), a - 1)
                if m and any(folded(p) in self.given for p in m[1].split()):
                    p, q = m.span(1)
                    tokens = [(x.start() + p, x.end() + p, x[0]) for x in re.finditer(r"\S+", m[1])]
                    while len(tokens) > 1 and (tokens[0][2] in TITLES or folded(tokens[0][2]) in _NOT_NAME):
                        tokens = tokens[1:]
                    if len(tokens) in (2, 3) and not any(self.kind(t) == "o" for *_, t in tokens):
                        yield tokens[0][0], q


_DIGITS = re.compile(r"\d[\d .()/-]{5,}\d|\d\d[A-Z]{2}\d{5}|\d{6}[A-Z]\d{5}|[A-Z]{2} ?\d\d ?\d\d")


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """E-mail addresses, found from their @."""
    at = text.find("@")
    while at >= 0:
        a = at
        while a and (text[a - 1].isalnum() or text[a - 1] in "._+'-"):
            a -= 1
        while a < at and not text[a].isalnum():
            a += 1
        m = _DOMAIN.match(text, at + 1)
        if m and a < at and text[at - 1] not in ".'":
            yield a, m.end()
        at = text.find("@", at + 1)


def find(text: str, names: Names) -> list[tuple[int, int, str]]:
    """Spans of personal information in source characters, in order, without overlap."""
    shape, spans = plain(text)
    taken: list[tuple[int, int, str]] = []
    covered = bytearray(len(shape))

    def take(a: int, b: int, kind: str) -> None:
        if b > a and not any(covered[a:b]):
            covered[a:b] = b"\x01" * (b - a)
            taken.append((a, b, kind))

    numbers = _DIGITS.search(shape)
    if numbers:
        for m in _IDS.finditer(shape):
            take(m.start(), m.end(), "id_number")
    emails = []
    if "@" in shape:
        for a, b in addresses(shape):
            emails.append((a, b))
            take(a, b, "email")
    if numbers:
        for m in _PHONE.finditer(shape):
            take(m.start(), m.end(), "phone")
    if _ROAD_HINT.search(shape):
        for m in _ADDRESS.finditer(shape):
            b = m.end()
            while b > m.start() and shape[b - 1] in " \t\r\n,.-–>|":
                b -= 1
            take(m.start(), b, "street_address")
    for a, b in names.others(shape, emails):
        take(a, b, "person_name")
    for a, b in names.find(shape):
        take(a, b, "person_name")
    taken.sort()
    if spans is None:
        return taken
    return [(spans[a][0], spans[b - 1][1], k) for a, b, k in taken]


def redacted(text: str, names: Names) -> str:
    out, last = [], 0
    for a, b, kind in find(text, names):
        out.append(text[last:a])
        out.append(PLACEHOLDERS[kind])
        last = b
    return "".join([*out, text[last:]])


# ---------------------------------------------------------------- tables


def learn_given(emails: DataFrame) -> frozenset[str]:
    """Given names: words of contact names that pair with many different words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs: set[tuple[str, str, bool]] = set()
            for name in batch.column(0).to_pylist():
                t = [w for w in re.findall(r"[^\W\d_][\w'’-]+", folded(name)) if w + "." not in TITLES]
                if len(t) == 2 and "@" not in name:
                    pairs.update(((t[0], t[1], True), (t[1], t[0], False)))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], t) for k, t in enumerate((pa.string(), pa.string(), pa.bool_()))], names=["word", "other", "first"])

    contact = lambda c: F.transform(F.coalesce(F.col(c), F.array()), lambda x: x["name"])
    names = emails.select(F.explode(F.concat(F.array("author.name"), contact("targets"), contact("cc"), contact("bcc"))).alias("name")).where("name is not null").distinct()
    pairs = names.mapInArrow(run, "word string, other string, first boolean").groupBy("word", "other").agg(F.max(F.col("first").cast("int")).alias("first"), F.max((~F.col("first")).cast("int")).alias("last"))
    counted = pairs.groupBy("word").agg(F.count("*").alias("n"), F.sum("first").alias("first"), F.sum("last").alias("last"))
    total = pairs.count()
    n = F.col("n")
    rows = counted.where((n >= PAIRS_LEAST) & ((n >= F.lit(PAIRS_SHARE * total)) | (F.col("first") >= F.col("last")))).collect()
    titles = {folded(t).strip(".") for t in TITLES}
    return frozenset(r["word"] for r in rows if r["word"] not in titles and r["word"] not in _NOT_PERSON)


def learn_contexts(texts: DataFrame, given: frozenset[str]) -> Names:
    """The detector with the words that stand before and after names in the texts.

    Two words are a context of names if, of the capitalised words behind them, so many and such a share are full names
    (a known given name with a surname).  Contexts are kept as slots of a table of fixed size.  A word follows names if it
    stands behind such a share of all full names.
    """
    shared = texts.sparkSession.sparkContext.broadcast(Names(given))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = shared.value
        hits: Counter = Counter()
        total: Counter = Counter()

        def told() -> pa.RecordBatch:
            keys = list(total)
            cols = ([k[0] for k in keys], [k[1] for k in keys], [slot(k[1]) for k in keys], [hits[k] for k in keys], [total[k] for k in keys])
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["side", "context", "slot", "hits", "total"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                for a, b, sure in names.certain(text):
                    if (c := context_before(text, a)) is not None:
                        total["before", c] += 1
                        hits["before", c] += sure
                    if sure:
                        m = _AFTER.match(text, b)
                        key = ("after", m[1].lower() if m[1] and m[1].isalpha() and "\n" not in m[0] else "")
                        total[key] += 1
                        hits[key] += 1
            if len(total) > 200_000:
                yield told()
                hits, total = Counter(), Counter()
        yield told()

    sums = persisted(texts.where(F.length("text") > 0).select("text").mapInArrow(run, "side string, context string, slot int, hits long, total long").groupBy("side", "context", "slot").agg(F.sum("hits").alias("hits"), F.sum("total").alias("total")), "contexts")
    before = sums.where(f"side = 'before' and hits >= {CONTEXT_LEAST} and hits >= {CONTEXT_SHARE} * total").select("slot").distinct().collect()  # no more than SLOTS
    full = sums.where("side = 'after'").agg(F.sum("hits")).first()[0] or 0
    after = sums.where(f"side = 'after' and context <> '' and hits >= {max(AFTER_LEAST, AFTER_SHARE * full)}").select("context").collect()  # no more than 1 / AFTER_SHARE
    return Names(given, frozenset(r[0] for r in before), frozenset(r[0] for r in after))


def texts_of(emails: DataFrame, uploads: DataFrame) -> DataFrame:
    """(origin, row_id, field, text) of all texts."""
    each = F.transform(F.coalesce("attachments", F.array()), lambda a, i: F.struct(F.concat(F.lit("attachments["), i.cast("string"), F.lit("].extracted_text")).alias("field"), a["extracted_text"].alias("text")))
    mails = emails.select(F.lit("parsed_emails").alias("origin"), F.col("record_id").cast("long").alias("row_id"), F.explode(each).alias("t")).select("origin", "row_id", "t.field", "t.text")
    both = F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("text")) for c in ("email_summary", "attachment_summary")))
    files = uploads.select(F.lit("dropbox_uploads").alias("origin"), F.col("upload_id").cast("long").alias("row_id"), F.explode(both).alias("t")).select("origin", "row_id", "t.field", "t.text")
    return mails.unionByName(files)


def found(texts: DataFrame, names: Names) -> DataFrame:
    """(origin, row_id, field, kind, pii_text): one row for each different value in a text."""
    shared = texts.sparkSession.sparkContext.broadcast(names)
    schema = "origin string, row_id long, field string, kind string, pii_text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = shared.value
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            for origin, row, field, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for kind, value in dict.fromkeys((k, text[a:b]) for a, b, k in find(text, names)):
                    for c, x in zip(cols, (origin, row, field, kind, value), strict=True):
                        c.append(x)
            types = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["origin", "row_id", "field", "kind", "pii_text"])

    return texts.where(F.length("text") > 0).mapInArrow(run, schema).distinct()


def without_private(texts: DataFrame, names: Names) -> DataFrame:
    """(origin, row_id, field, text) with placeholders for all values."""
    shared = texts.sparkSession.sparkContext.broadcast(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = [redacted(t, shared.value) if t else t for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(new, pa.string())], names=["origin", "row_id", "field", "text"])

    return texts.mapInArrow(run, "origin string, row_id long, field string, text string")
