"""HTML and XML bodies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lettrine.functions import text as X

HTML_BYTES = 250_000
#: Fixed value: the notice behind a cut body.
CUT_NOTICE = "\n\n[message truncated during HTML to Markdown conversion]"
#: Elements whose content is no text.
NOISE = ("script", "style", "head", "title", "svg", "noscript")
#: Elements that end a block.
BLOCKS = "p|div|section|article|tr|table|li|ul|ol|h[1-6]"
BODY_CHARS, BODY_PART_CHARS = 24_000, 12_000


def noise_pattern(flags: str = "(?is)") -> str:
    """Matches whole elements that hold no text, meta elements and comments, whichever begins first."""
    whole = "|".join(rf"<\s*{tag}\b[^>]*>.*?</\s*{tag}\s*>" for tag in NOISE)
    return rf"{flags}{whole}|<\s*meta\b[^>]*>|<!--.*?-->"


def strip_noise(c: Column) -> Column:
    """One scan that leaves a blank for each part without text."""
    return F.regexp_replace(c, noise_pattern(), " ")


#: Each step's pattern and replacement, in order; None stands for decoding character references.
STEPS = (
    (r"(?is)<\s*br\s*/?\s*>", "\n"),
    (rf"(?is)</\s*({BLOCKS})\s*>", "\n\n"),
    (r"(?is)<\s*li\b[^>]*>", "- "),
    (r"""(?is)<\s*a\b[^>]*href\s*=\s*["']([^"']+)["'][^>]*>(.*?)</\s*a\s*>""", "[$2]($1)"),
    (r"(?is)<[^>]+>", " "),
    None,
    (r"\r\n?", "\n"),
    (r"[ \t]+", " "),
    (r"\n{3,}", "\n\n"),
)


def html_to_markdown(x: Column | str, entities: bool = True) -> Column:
    """HTML as Markdown. At most the first 250,000 bytes are read, cut at a character; a notice tells so."""
    c = F.col(x) if isinstance(x, str) else x
    size = F.octet_length(c)
    head = F.regexp_replace(F.make_valid_utf8(F.substring(F.encode(c, "UTF-8"), 1, HTML_BYTES).cast("string")), r"�+\z", "")
    out = strip_noise(F.when(size > HTML_BYTES, head).otherwise(c))
    for step in STEPS:
        if step:
            out = F.regexp_replace(out, *step)
        elif entities:
            out = X.decode_entities(out)
    return F.concat(X.trim(out), F.when(size > HTML_BYTES, F.lit(CUT_NOTICE)).otherwise(F.lit("")))


#: How the stored messages enclose a body, and a block.
_END, _OPEN = "]]></content>", r"(?s)<content\b([^>]*)><!\[CDATA\[(.*)\z"


def body_for_prompt(xml: Column | str) -> Column:
    """The bodies in an XML message as labelled parts; the XML itself if it has none.

    Parts are numbered with the empty ones, which are left out.
    """
    c = F.col(xml) if isinstance(xml, str) else xml
    # each piece but the last ends where a body ends; its first opening tag begins that body
    pieces = F.split(c, "\\Q" + _END + "\\E", -1)
    opened = F.filter(F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0))), lambda p: p.rlike(_OPEN))

    def label(attrs: Column, i: Column) -> Column:
        form = F.regexp_extract(attrs, r'(?<![\w-])format="([^"]*)"', 1)
        source = F.regexp_extract(attrs, r'source-format="([^"]*)"', 1)
        told = F.when(source != "", F.concat(form, F.lit(" from "), source)).otherwise(form)
        return F.concat(F.lit("Part "), (i + 1).cast("string"), F.lit(" ["), told, F.lit("]"))

    parts = F.transform(opened, lambda p, i: F.struct(label(F.regexp_extract(p, _OPEN, 1), i).alias("label"), X.trim(F.regexp_extract(p, _OPEN, 2)).alias("body")))
    kept = F.transform(F.filter(parts, lambda p: p["body"] != ""), lambda p: F.concat(p["label"], F.lit("\n"), X.truncate_chars(p["body"], BODY_PART_CHARS)))
    return F.when(F.size(kept) > 0, F.array_join(kept, "\n\n")).otherwise(X.truncate_chars(c, BODY_CHARS))


def _last(c: Column, word: str) -> Column:
    """Where the last ``word`` begins, 0 if there is none."""
    back = F.instr(F.reverse(c), word[::-1])
    return F.when(back > 0, F.length(c) - back - len(word) + 2).otherwise(0)


def embed_block(xml: Column | str, payload: Column, tag: str = "enrichment", root: str = "email-content") -> Column:
    """The XML with a CDATA block before its last closing root tag; an older block is replaced.

    ``tag`` is the name that the stored messages use.
    """
    c = F.col(xml) if isinstance(xml, str) else xml
    begin, end = f"<{tag}><![CDATA[", f"]]></{tag}>"
    # what stands between an old block and its neighbours shrinks to one line end
    pieces = F.split(c, "\\Q" + begin + "\\E", -1)

    def appended(done: Column, piece: Column) -> Column:
        at = F.instr(piece, end)
        after = F.regexp_replace(piece.substr(at + len(end), F.length(piece)), r"\A\s+", "")
        return F.when(at > 0, F.concat(F.regexp_replace(done, r"\s+\z", ""), F.lit("\n"), after)).otherwise(F.concat(done, F.lit(begin), piece))

    clean = F.aggregate(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(1))), pieces[0], appended)
    block = F.concat(F.lit(f"  {begin}"), X.wrap_cdata(payload), F.lit(f"{end}\n"))
    at = _last(clean, f"</{root}>")
    return F.when(at > 0, F.concat(F.substring(clean, F.lit(1), at - 1), block, F.substring(clean, at, F.length(clean)))).otherwise(F.concat(clean, F.lit("\n"), block))
