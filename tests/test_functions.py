import hashlib

import pytest
from pyspark.sql import functions as F

from lettrine.functions import dates, hashes, markup, responses
from lettrine.functions import text as X


@pytest.mark.parametrize(("given", "wanted"), [(" A:B/C? ", "ABC"), ("a\\b|c", "a\\bc"), (" x ", "x"), ("", ""), (None, None)])
def test_sanitize_keeps_backslash(one, given, wanted):
    assert one(X.sanitize_file_name(F.lit(given).cast("string"))) == wanted


def test_sanitize_for_the_store_drops_backslash_and_decodes_entities(one):
    assert one(X.sanitize_file_name(F.lit("a\\b&eacute;&amp;lt;&copy &#128;"), drop_backslash=True, entities=True)) == "abé&lt;&copy \x80"


@pytest.mark.parametrize(
    ("given", "wanted"),
    [("Direction gÃ©nÃ©rale", "Direction générale"), ("=utf-8QChlo=C3=A9_SAUNIER=", "Chloé SAUNIER"), ("=utf-8QChlo=C3=A9_S+A%=", "Chloé S+A%"), ("=utf-8QBob=", "=utf-8QBob="), (" '\"Zoé\"' ", "Zoé"), ("Âge", "�ge"), (None, None)],
)
def test_display_names(one, given, wanted):
    assert one(X.normalize_display_name(F.lit(given).cast("string"))) == wanted


@pytest.mark.parametrize(("given", "name", "email"), [("Bob <B@Y>", "Bob", "b@y"), ("A <a@x>, B <b@y>", "A <a@x>, B", "b@y"), ("a@x", "", "a@x"), ("", "", "")])
def test_contact_info(one, given, name, email):
    got = one(X.contact_info(F.lit(given)))
    assert (got["name"], got["email"]) == (name, email)


def test_paths(one):
    assert one(X.normalize_root(F.lit(" Mes docs/Impots "))) == "/Mes docs/Impots"
    assert one(X.normalize_root(F.lit(" "))) is None
    assert one(X.normalize_root(F.lit("/a/??"))) is None
    assert one(X.store_path(F.lit("/Archives"), F.lit("avis.pdf"))) == "/Archives/A_TRAITER/avis.pdf"
    assert one(X.store_path(F.lit("/"), F.lit("avis.pdf"))) == "/A_TRAITER/avis.pdf"
    assert one(X.ensure_extension(F.lit("2024-03-15 bnpp releve detaille"), F.lit("source.pdf"))) == "2024-03-15 bnpp releve detaille.pdf"
    assert one(X.ensure_extension(F.lit("2024-03 v1.2 doc"), F.lit("a.pdf"))) == "2024-03 v1.pdf"
    assert one(X.ensure_extension(F.lit(""), F.lit("a.pdf"))) == "a.pdf"
    assert one(X.ensure_extension(F.lit(None).cast("string"), F.lit(""))) == "attachment.bin"
    assert one(X.folder_prefixes(F.lit("/Archives/X/Y"))) == ["/Archives", "/Archives/X", "/Archives/X/Y"]
    assert one(X.folder_prefixes(F.lit(""))) == []
    assert one(X.parent_folder(F.lit("/a"))) == "/"
    assert one(X.stem_or(F.lit(".hidden"), "email")) == ".hidden"
    assert one(X.stem_or(F.lit("??.pdf"), "email")) == "email"
    assert one(X.strip_suffixes(F.lit("a.ai.json.ai.json"), ".ai.json")) == "a"


def test_path_order(spark):
    rows = spark.createDataFrame([("a-b",), ("a/b",), ("a",)], "p string").orderBy(X.path_order("p")).collect()
    assert [r[0] for r in rows] == ["a", "a/b", "a-b"]


def test_small_things(one):
    assert one(X.truncate_chars(F.lit("abcdef"), 3)) == "abc\n...[truncated]"
    assert one(X.truncate_chars(F.lit("🔴ab"), 3)) == "🔴ab"
    assert [one(X.is_text_like(F.lit(n))) for n in ("a.txt", "a.json", "a.pdf")] == [True, True, False]
    assert one(X.guess_mime_type(F.lit("a.JPEG"))) == "image/jpeg"
    assert one(X.guess_mime_type(F.lit("none"))) == "application/octet-stream"
    assert one(X.normalize_subject(F.lit("🔴 Bonjour"))) == "Bonjour"
    assert one(X.wrap_cdata(F.lit("a]]>b"))) == "a]]]]><![CDATA[>b"
    assert one(X.compact_body(F.lit("  "))) == "<empty body>"
    assert [one(X.extract_year(F.lit(v))) for v in ("le 15-03-2024", "fact_2024", "20240315", "é2024", "1850")] == ["2024", "", "", "", ""]
    assert one(X.looks_temporary(F.lit("attestation.pdf"))) is True
    assert one(X.looks_temporary(F.lit(None).cast("string"))) is False
    assert one(X.finalize_extraction(F.lit(" a\r\nb "), 2)) == ("a\n", True)


@pytest.mark.parametrize("size", [0, 42, 4 * 1024 * 1024, 4 * 1024 * 1024 + 17])
def test_content_hash(spark, size):
    data = b"x" * size
    block = hashes.BLOCK
    wanted = hashlib.sha256(b"".join(hashlib.sha256(data[i : i + block]).digest() for i in range(0, size, block))).hexdigest()
    assert spark.createDataFrame([(bytearray(data),)], "content binary").select(hashes.block_hash("content")).first()[0] == wanted


def test_input_hash(one):
    assert one(hashes.input_hash(F.lit("a"), F.lit("b"), F.lit(None).cast("string"))) == hashlib.sha256(b"2ab").hexdigest()
    assert one(hashes.content_md5(F.lit(None).cast("binary"))) == ""


@pytest.mark.parametrize(
    ("given", "wanted"),
    [("Tue, 17 Nov 2026 10:00:00 +0100", "2026-11-17T09:00:00+00:00"), ("17 Nov 2026 10:00:00 GMT", "2026-11-17T10:00:00+00:00"), ("nonsense", None), ("", None), (None, None), ("Tue, 17 Nov 26 10:00:00 EST", "2026-11-17T15:00:00+00:00")],
)
def test_message_date(one, given, wanted):
    assert one(dates.message_date(F.lit(given).cast("string"), obsolete_zones=True)) == wanted


def test_html(one):
    html = "<html><head><title>t</title></head><body><p>a&eacute;<br>b</p><ul><li>x</li></ul><a href='u'>v</a><script>no</script><!-- c --></body></html>"
    from lettrine.plans.mime import html_text

    assert one(markup.html_to_markdown(F.lit(html))) == html_text(html) == "aé\nb\n\n - x\n\n[v](u)"


def test_long_html_is_cut_at_a_character(one):
    html = "x" * (markup.HTML_BYTES - 1) + "éé"
    got = one(markup.html_to_markdown(F.lit(html)))
    assert got == "x" * (markup.HTML_BYTES - 1) + markup.CUT_NOTICE


def test_bodies(one):
    xml = '<p><content format="plain"><![CDATA[ ]]></content><content format="markdown" source-format="html"><![CDATA[Bonjour]]></content></p>'
    assert one(markup.body_for_prompt(F.lit(xml))) == "Part 2 [markdown from html]\nBonjour"
    assert one(markup.body_for_prompt(F.lit("<x/>"))) == "<x/>"


def test_block(one):
    once = markup.embed_block(F.lit("<email-content>\n</email-content>"), F.lit('{"a":"$1 \\\\ ]]>"}'))
    text = one(once)
    assert '<![CDATA[{"a":"$1 \\\\ ]]]]><![CDATA[>"}]]>' in text and text.endswith("</email-content>")
    again = one(markup.embed_block(F.lit("<email-content>\n  <enrichment><![CDATA[old]]></enrichment>\n</email-content>"), F.lit("new")))
    assert "old" not in again and again.count("enrichment") == 2
    assert one(markup.embed_block(F.lit("none"), F.lit("p"))).startswith("none\n  <enrichment>")


def test_output_json(one):
    assert one(responses.output_json(F.lit('{"output_text": "{\\"a\\":1}"}'))) == '{"a":1}'
    assert one(responses.output_json(F.lit('{"output": [{"content": [{"text": "x"}, {"arguments": "[1]"}]}]}'))) == "[1]"
    assert one(responses.output_json(F.lit("no json"))) is None
