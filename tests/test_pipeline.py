import hashlib
import json
import os
import textwrap

import pytest
from pyspark.sql import functions as F

from lettrine.functions import markup
from lettrine.plans import enrich, filing, ingest, mime, parse, spec
from lettrine.plans.pipeline import Run
from lettrine.schemas import ATTACHMENT
from lettrine.sources import archive, config, files, index, mailbox
from lettrine.streaming import ingest as stream

HEAD = "From: Alice <alice@example.org>\r\nTo: Bob <bob@example.org>\r\nSubject: Engagement\r\nDate: Tue, 17 Nov 2026 10:00:00 +0100\r\nMessage-ID: <test{n}@example.org>\r\nMIME-Version: 1.0\r\n"
PLAIN = "Content-Type: text/plain\r\n\r\nBonjour]]> le monde\r\n"
HTML = "Content-Type: text/html\r\n\r\n<p>Bonjour</p>\r\n"
ALTERNATIVE = 'Content-Type: multipart/alternative; boundary="b"\r\n\r\n--b\r\nContent-Type: text/plain\r\n\r\nplain body\r\n--b\r\nContent-Type: text/html\r\n\r\n<p>html body</p>\r\n--b--\r\n'
RELATED = 'Content-Type: multipart/related; boundary="b"\r\n\r\n--b\r\nContent-Type: text/plain\r\n\r\nrelated body\r\n--b\r\nContent-Type: image/png; name="image001.png"\r\nContent-ID: <i>\r\nContent-Disposition: inline; filename="image001.png"\r\nContent-Transfer-Encoding: base64\r\n\r\naGVsbG8=\r\n--b--\r\n'
MIXED = 'Content-Type: multipart/mixed; boundary="b"\r\n\r\n--b\r\nContent-Type: text/plain\r\n\r\nmixed body\r\n--b\r\nContent-Type: text/plain; name="contract.txt"\r\nContent-Disposition: attachment; filename="contract.txt"\r\n\r\nContract content\r\n\r\n--b\r\nContent-Type: text/plain\r\nContent-Disposition: attachment; filename="contract.txt"\r\n\r\nOther\r\n--b\r\nContent-Type: message/rfc822\r\n\r\nSubject: inner\r\nContent-Type: multipart/mixed; boundary="c"\r\n\r\n--c\r\nContent-Type: text/plain\r\n\r\ninner body\r\n--c\r\nContent-Type: application/pdf\r\nContent-Disposition: attachment; filename="in.pdf"\r\n\r\nx\r\n--c--\r\n--b--\r\n'
SPEC = '## Goal\nFile it.\n\n## Folder Taxonomy\n```json\n{"ALPHA": ["LEGAL", " LOCATION "], "BETA": ["TAX"]}\n```\n'


def raw(body, n=1):
    return (HEAD.format(n=n) + body).encode()


@pytest.mark.parametrize(("body", "text"), [(PLAIN, "Bonjour]]]]><![CDATA[> le monde"), (HTML, "Bonjour"), (ALTERNATIVE, "plain body"), (RELATED, "related body")])
def test_bodies_without_documents(body, text):
    data = raw(body)
    m = mime.parse_message("p", data)
    assert [a["meta"]["original_name"] for a in m["attachments"]] == ["email-body.xml"] and m["attachments"][0]["meta"]["md5"] == hashlib.md5(data).hexdigest()
    assert text in m["body_xml"] and "html body" not in m["body_xml"] and m["message_id"] == "<test1@example.org>"


def test_documents_and_nested_messages():
    m = mime.parse_message("p", raw(MIXED))
    assert [(a["meta"]["original_name"], a["meta"]["is_email_body"]) for a in m["attachments"]] == [("contract.txt", None), ("contract_1.txt", None)]
    assert m["attachments"][0]["content"].startswith(b"Contract content") and "inner body" in m["body_xml"] and 'kind="message"' in m["body_xml"] and "in.pdf" not in m["body_xml"]


def test_contacts():
    assert mime.contacts("Team: a@x, b@x;, Bob <b@y>") == [{"raw": "Team: a@x, b@x;", "name": "Team", "address": None}, {"raw": "Bob <b@y>", "name": "Bob", "address": "b@y"}]
    assert mime.contacts("no address here")[0]["address"] is None and mime.contacts(None) == [] == mime.contacts(" ")


def test_unreadable_message_is_an_error():
    assert mime.parse_message("p", None)["error"]


# ------------------------------------------------------------------ specification


def test_spec():
    s = spec.read(SPEC)
    assert s.taxonomy == {"ALPHA": ["LEGAL", "LOCATION"], "BETA": ["TAX"]} and s.fingerprint == hashlib.sha256(SPEC.encode()).hexdigest()
    items = s.schema["properties"]["attachment_summaries"]["items"]
    assert len(items["anyOf"]) == 2 and items["properties"]["sub_folder"]["enum"] == ["LEGAL", "LOCATION", "TAX"] and s.instructions.startswith("## Goal\nFile it.")
    assert spec.cache_key("ai", "m", "1234567890abcdefff", True) == "ai:m:1234567890abcdef:repair"


@pytest.mark.parametrize("text", ["# none", "## Folder Taxonomy\n```json\n[]\n```", '## Folder Taxonomy\n```json\n{"A": []}\n```', "## Folder Taxonomy\n```json\n{}\n```"])
def test_bad_taxonomy(text):
    with pytest.raises(spec.SpecError):
        spec.taxonomy(text)


def test_schema_migration_and_hardening():
    old = {"type": "object", "required": ["main_folder", "x"], "properties": {"main_folder": {"type": "string", "enum": ["A"]}, "x": {"type": "string"}, "o": {"type": "string"}, "attachment_summaries": {"type": "array", "items": {"type": "object", "required": ["confidence"], "properties": {"confidence": {"type": "number"}}}}}}
    new = spec.migrated(old)
    item = new["properties"]["attachment_summaries"]["items"]
    assert "main_folder" not in new["properties"] and new["required"] == ["x"] and item["required"] == ["main_folder", "sub_folder"] and item["properties"]["main_folder"]["enum"] == ["A"]
    hard = spec.hardened(new)
    assert hard["properties"]["o"]["type"] == ["string", "null"] and hard["required"] == list(hard["properties"]) and hard["additionalProperties"] is False


# ------------------------------------------------------------------ configuration


def test_secrets():
    assert config.resolve_secret("=${MAIL_2}", {"MAIL_2": "a$b"}) == config.resolve_secret("${MAIL_2}", {"MAIL_2": "a$b"}) == "a$b"
    assert config.resolve_secret("abc${KEY}", {}) == "abc${KEY}"
    for bad in ("${NONE}", "${EMPTY}", "=${BAD-NAME}"):
        with pytest.raises(config.ConfigError):
            config.resolve_secret(bad, {"EMPTY": ""})


def test_config(tmp_path):
    p = tmp_path / "c.yml"
    p.write_text("baseFolder: /x # here\naiEnabled: true\naiRetryCount: 3\naccounts:\n  - name: A\n    password: ${PW}\n    foldersOut: [Sent]\n  - name: B\n    foldersIn:\n      - INBOX\n")
    c = config.load(str(p), {"PW": "s"})
    assert (c.baseFolder, c.aiEnabled, c.aiRetryCount, c.parseIaFolder) == ("/x", True, 3, "parse-ai")
    assert [(a.name, a.password, a.foldersOut, a.foldersIn) for a in c.accounts] == [("A", "s", ["Sent"], []), ("B", "", [], ["INBOX"])]
    assert config.agents_path(c) == str(tmp_path / "AGENTS.md") and config.root_folder(c, " /r ") == "/r"
    with pytest.raises(config.ConfigError):
        config.root_folder(c)
    assert config.access_token({"token": "t"}) == "t"
    for options in ({}, {"refresh_token": "r"}, {"refresh_token": "r", "app_key": "k", "app_secret": "s"}):
        with pytest.raises(config.ConfigError):
            config.access_token(options)


# ------------------------------------------------------------------ enrichment


def test_retries_and_repairs():
    s = spec.read(SPEC)
    good = {"email_summary": "s", "email_importance": "HAUTE", "attachment_summaries": [{"file_name": "f", "mime_type": None, "summary": "s", "importance": "BASSE", "proposed_file_name": "2024 f", "main_folder": "BETA", "sub_folder": "TAX"}]}
    bad = json.loads(json.dumps(good))
    bad["attachment_summaries"][0]["sub_folder"] = "LEGAL"
    answers = [enrich.ServiceError(503, "busy"), {"output_text": json.dumps(bad)}, {"output": [{"content": [{"text": json.dumps(good)}]}]}]
    asked, slept = [], []

    def model(request):
        asked.append(request)
        a = answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    pacer = enrich.Pacer(0, slept.append)
    assert enrich.enrich_one(model, {"prompt": "p", "cache_key": "k"}, s, 2, pacer) == good
    assert slept == [1] and asked[-1]["cache_key"] == "k:repair" and "Current JSON" in asked[-1]["prompt"]
    assert not enrich.ServiceError(429, '{"error":{"code":"insufficient_quota"}}').retryable and enrich.ServiceError(429).retryable


# ------------------------------------------------------------------ the whole pipeline


@pytest.fixture
def run(spark, tmp_path):
    for account, bodies in {"ALPHA": [PLAIN, HTML, ALTERNATIVE, MIXED], "BETA": [RELATED, PLAIN]}.items():
        d = tmp_path / account / "_in.box"
        d.mkdir(parents=True)
        for n, b in enumerate(bodies):
            (d / f"_{n}.EML").write_bytes(raw(b, n))
    (tmp_path / "ALPHA" / "broken.eml").write_bytes(b"")
    (tmp_path / "AGENTS.md").write_text(SPEC)
    accounts = [config.Account(name="ALPHA"), config.Account(name="BETA"), config.Account(name="NONE")]
    c = config.Config(baseFolder=str(tmp_path), parseIaFolder="_parse-ai", aiEnabled=True, dropboxRootFolder="/Archives", accounts=accounts, path=str(tmp_path / "config.yml"))
    return Run(spark, c)


def _files(folder):
    return sorted(os.path.relpath(os.path.join(d, f), folder) for d, _, fs in os.walk(folder) for f in fs)


def test_pipeline_twice(spark, run):
    run.parse()
    run.enrich()
    plans = run.file()
    documents = spark.read.parquet(os.path.join(run.work, "bundles"))
    assert documents.where("email_file_name <> 'broken.eml'").count() == 7 and plans.count() >= 6
    rows = archive.load(spark, os.path.join(run.work, "archive"))
    n = rows.count()
    assert n == plans.count() == rows.select("md5").distinct().count() and rows.where("main_folder = 'ALPHA' and sub_folder = 'LEGAL' and layout_version = '5'").count() == n
    stored = _files(os.path.join(run.work, "store"))
    assert any(f.endswith(".txt") for f in stored) and sum(f.endswith(".xml") for f in stored) >= 1
    r = rows.where("source_file_name = 'contract.txt'").first()
    assert r["dropbox_content_hash"] and "<enrichment>" in r["parse_xml_content"] and r["expedition_date"] == "2026-11-17T09:00:00+00:00" and json.loads(r["parse_json_content"])["attachments"][0]["original_name"] == "contract.txt"
    # nothing is done twice
    run.parse()
    run.enrich()
    run.file()
    assert spark.read.parquet(os.path.join(run.work, "bundles")).count() == documents.count()
    assert archive.load(spark, os.path.join(run.work, "archive")).count() == n and _files(os.path.join(run.work, "store")) == stored


def test_dry_runs_write_nothing(spark, run):
    run.parse("ALPHA")
    asked = run.enrich(dry_run=True, limit=2)
    assert asked.count() == 2 and not os.path.isdir(os.path.join(run.work, "outputs"))
    request = json.loads(asked.first()["request"])
    assert "extracted_text_method" not in request["prompt"] and request["cache_key"].startswith("enrich:")
    run.enrich()
    run.file(dry_run=True)
    assert not os.path.isdir(os.path.join(run.work, "archive")) and not os.path.isdir(os.path.join(run.work, "store"))


def test_failures_become_rows(spark, run):
    run.parse("BETA")

    def factory():
        def model(request):
            raise enrich.ServiceError(400, "no")

        return model

    run.model_factory = factory
    assert run.enrich().count() == 0
    failed = spark.read.parquet(os.path.join(run.work, "failures")).where("stage = 'enrich'")
    assert failed.count() == 2 and "status 400" in failed.first()["error"]


def test_ingest_saves_each_message_once(spark, run, tmp_path):
    mail = tmp_path / "imap"
    for folder, body, n in (("Sent", PLAIN, 1), ("INBOX", PLAIN, 1), ("INBOX2", HTML, 2)):
        (mail / folder).mkdir(parents=True, exist_ok=True)
        (mail / folder / f"{n}.eml").write_bytes(raw(body, n))
    (mail / "INBOX" / "noid.eml").write_bytes(b"Subject: x\r\n\r\ny")
    base = tmp_path / "mails"
    run.config.baseFolder = str(base)
    base.mkdir()
    run.config.accounts = [config.Account(name="A", foldersOut=["Sent"])]
    run.ingest(lambda a: str(mail))
    first = _files(base / "A")
    assert first == sorted(["Alice (alice@example.org)/🔴 Engagement.eml", "bob@example.org/🔵 Engagement.eml"]) or len(first) == 2
    assert sorted(r["id"] for r in index.load(spark, str(base / "message-index.json")).collect()) == ["<test1@example.org>", "<test2@example.org>"]
    run.ingest(lambda a: str(mail))
    assert _files(base / "A") == first


def test_stream(spark, run, tmp_path):
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    for _ in range(2):
        stream.start(spark, str(tmp_path / "ALPHA"), out, check).awaitTermination()
    assert spark.read.parquet(f"{out}/bundles").count() == 6
    # a file that comes later with an older date is read too
    late = tmp_path / "ALPHA" / "late.eml"
    late.write_bytes(raw(PLAIN, 77))
    os.utime(late, (1_000_000, 1_000_000))
    stream.start(spark, str(tmp_path / "ALPHA"), out, check).awaitTermination()
    assert spark.read.parquet(f"{out}/bundles").where("stem = 'late'").count() == 1 and spark.read.parquet(f"{out}/bundles").count() == 7


def test_no_file_of_a_large_folder_is_left_out(spark, tmp_path):
    mailbox.register(spark)
    (tmp_path / "in").mkdir()
    for n in range(10_005):
        (tmp_path / "in" / f"{n}.eml").touch()
    assert spark.read.format("mailbox").option("path", str(tmp_path)).option("content", "false").load().count() == 10_005
    assert sum(len(p.rows) for p in mailbox._Reader({"path": str(tmp_path)}).partitions()) == 10_005


def test_mailbox_options(spark, tmp_path):
    mailbox.register(spark)
    for f in ("a/1.eml", "a/2.EML", "skip/3.eml", ".h/_4.eml", "a/5.txt"):
        p = tmp_path / f
        p.parent.mkdir(exist_ok=True)
        p.write_bytes(b"x")
    read = lambda **o: sorted(r["name"] for r in spark.read.format("mailbox").options(path=str(tmp_path), **o).load().collect())
    assert read() == ["1.eml", "2.EML", "3.eml", "_4.eml"] and read(skip="skip", anyCase="false") == ["1.eml", "_4.eml"] and read(perFolder="1") == ["1.eml", "3.eml", "_4.eml"]
    assert spark.read.format("mailbox").option("path", str(tmp_path / "none")).load().count() == 0


# ------------------------------------------------------------------ archive


def test_archive(spark, tmp_path):
    path = str(tmp_path / "archive")
    assert archive.load(spark, path).count() == 0
    rows = spark.createDataFrame([("abc", 3, "x"), ("abc", 4, "y"), (None, 5, "z")], "md5 string, year_folder int, other string")
    assert archive.append(spark, path, rows, dry_run=True) == 2 and archive.load(spark, path).count() == 0
    assert archive.append(spark, path, rows) == 2 and archive.append(spark, path, rows) == 0
    got = {r["md5"]: r["year_folder"] for r in archive.register(spark, path, "kept").collect()}
    assert set(got) == {"abc", ""} and spark.sql("SELECT count(*) FROM kept WHERE email_subject = ''").first()[0] == 2
    old = str(tmp_path / "old")
    rows.write.parquet(old)
    assert {r["year_folder"] for r in archive.load(spark, old).collect()} == {"3", "4", "5"}


def test_local_store(tmp_path):
    s = filing.LocalStore(str(tmp_path), single_call=4, chunk=3)
    s.ensure_folder("/a/b")
    s.put("/a/b/f", b"0123456789")
    s.put("/a/b/f", b"0123456789")
    s.put("/a/b/empty", b"")
    assert (tmp_path / "a/b/f").read_bytes() == b"0123456789"
    with pytest.raises(filing.Conflict):
        s.put("/a/b/f", b"other")


def test_the_next_copy_is_tried_when_an_upload_fails(spark):
    class Picky:
        def ensure_folder(self, path):
            pass

        def put(self, path, data):
            if "no" in path:
                raise filing.Conflict(path)

    plans = spark.createDataFrame([("A", f"s{i}", 0, md5, False, path, f"{path}.xml", b"x", "<x/>") for i, (md5, path) in enumerate([("m", "/no1"), ("m", "/no2"), ("m", "/yes"), ("m", "/later"), ("n", "/no"), ("o", "/fine")])], "folder string, stem string, position int, md5 string, xml_only boolean, dropbox_path string, xml_dropbox_path string, content binary, enriched_xml string")
    ranks = filing.to_file(plans, spark.createDataFrame([("z",)], "md5 string"))
    assert "content" not in ranks.columns
    done, errors = filing.upload_first(plans, ranks, Picky)
    assert sorted((r["md5"], r["stem"]) for r in done.collect()) == [("m", "s2"), ("o", "s5")]
    assert sorted(r["md5"] for r in errors.collect()) == ["m", "m", "n"]


def test_files_whose_names_clean_alike_are_parsed_once(spark):
    listing = spark.createDataFrame([("f", "x.eml", "/f/x.eml", b"1"), ("f", "x.EML", "/f/x.EML", b"2"), ("g", "x.eml", "/g/x.eml", b"3"), ("f", "y.eml", "/f/y.eml", b"4")], "folder string, name string, path string, content binary")
    got = parse.pending(listing, spark.createDataFrame([("f", "y")], "folder string, stem string"))
    assert "content" not in got.columns and sorted(r["path"] for r in got.collect()) == ["/f/x.EML", "/g/x.eml"]


def test_no_contents_in_aggregates(spark, tmp_path):
    mailbox.register(spark)
    (tmp_path / "1.eml").write_bytes(raw(PLAIN))
    mails = spark.read.format("mailbox").option("path", str(tmp_path)).load()
    none = spark.createDataFrame([], "id string")
    chosen = ingest.to_save(mails, none, none)
    saved = ingest.with_contents(chosen, mails)
    assert "content" not in chosen.columns and saved.count() == 1 and saved.first()["content"] == raw(PLAIN)
    pending = parse.pending(mails, spark.createDataFrame([], "folder string, stem string"))
    for df in (saved, pending):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert all("content" not in line for line in plan.split("\n") if "Aggregate" in line), plan
    assert mailbox.contents(pending).first()["content"] == raw(PLAIN)


def test_the_model_gets_the_files_that_it_is_to_look_at(spark, run):
    s = spec.read(SPEC)
    row = ("A", "f", "s", 0, [("scan.png", None, "image/png", 3, "m", None, None, None)], b"png", "{}", "<x/>", "h")
    df = spark.createDataFrame([row], f"account_name string, folder string, stem string, position int, attachments array<{ATTACHMENT}>, content binary, json string, xml string, input_hash string")
    for c in ("parsing_folder", "email_folder", "email_file_name", "message_id", "subject", "expedition_date", "author", "targets", "cc", "bcc"):
        df = df.withColumn(c, F.lit(None).cast("string"))
    asked = enrich.requests(df, s, "m", send_images=True)

    def factory():
        def model(request):
            if request.get("files") != [("scan.png", b"png")]:
                raise enrich.ServiceError(400, "no file")
            return enrich.stub_model(s)()(request)

        return model

    good, bad = enrich.run(asked, s, factory)
    assert (good.count(), bad.count()) == (1, 0)
    assert enrich.requests(df, s, "m").first()["file"] is None


def test_embedding_and_bodies(one):
    xml = "<email-content>\n<content format=\"plain\"><![CDATA[a <content format=\"x\"><![CDATA[ b]]></content><content><![CDATA[ ]]></content>]]></content></email-content>\n"
    assert one(markup.body_for_prompt(F.lit(xml))) == 'Part 1 [plain]\na <content format="x"><![CDATA[ b'
    first = one(markup.embed_block(F.lit(xml), F.lit("1]]>2")))
    assert first.endswith("<enrichment><![CDATA[1]]]]><![CDATA[>2]]></enrichment>\n</email-content>\n")
    assert one(markup.embed_block(F.lit(first), F.lit("3"))) == first.replace("  <enrichment>", "\n  <enrichment>").replace("1]]]]><![CDATA[>2", "3")
    assert one(markup.embed_block(F.lit("x"), F.lit("3"))) == "x\n  <enrichment><![CDATA[3]]></enrichment>\n" and one(markup.embed_block(F.lit(None).cast("string"), F.lit("3"))) is None


def test_remote_store():
    calls = []

    def transport(method, url, headers, body):
        calls.append((url.rsplit("/files/", 1)[1], json.loads(headers.get("Dropbox-API-Arg", "null")), body))
        if "create_folder" in url:
            return 409, b'{"error_summary": "path/conflict/folder/."}'
        if b"clash" in body:
            return 409, b'{"error_summary": "path/conflict/file/."}'
        return (500, b"") if b"down" in body else (200, b'{"session_id": "s"}')

    s = filing.RemoteStore("t", "http://a", "http://c", transport, single_call=5, chunk=3)
    s.ensure_folder("/x/y")
    s.ensure_folder("/x/z")
    assert [json.loads(c[2])["path"] for c in calls] == ["/x", "/x/y", "/x/z"]
    calls.clear()
    s.put("/é", b"12345")
    s.put("/big", b"0123456789")
    assert [(c[0], c[2]) for c in calls] == [("upload", b"12345"), ("upload_session/start", b"012"), ("upload_session/append_v2", b"345"), ("upload_session/append_v2", b"678"), ("upload_session/finish", b"9")]
    assert [c[1]["cursor"]["offset"] for c in calls[2:]] == [3, 6, 9] and calls[-1][1]["commit"]["path"] == "/big"
    with pytest.raises(filing.Conflict):
        s.put("/a", b"clash")
    with pytest.raises(OSError, match="status 500"):
        s.put("/a", b"down")


def test_remote_model():
    calls = []

    def transport(method, url, headers, body):
        calls.append((url, body))
        return (200, b'{"id": "f1"}') if url.endswith("/files") else (200, b'{"output_text": "{}"}') if len(calls) < 3 else (503, b"busy")

    model = enrich.remote_model("k", "http://m/v1/", transport)()
    request = {"model": "m", "instructions": "i", "prompt": "p", "schema": "{}", "cache_key": "c"}
    assert model(request | {"files": [("a.png", b"\x00png")]}) == {"output_text": "{}"}
    assert calls[0][0] == "http://m/v1/files" and b"\x00png" in calls[0][1] and json.loads(calls[1][1])["input"][0]["content"][1] == {"type": "input_file", "file_id": "f1"}
    with pytest.raises(enrich.ServiceError) as e:
        model(request)
    assert e.value.retryable


def test_folders_by_uri(tmp_path):
    f = files.Folder(f"file://{tmp_path}/u")
    f.make("a")
    f.write("a/x", b"0123", chunk=3)
    f.write("a/x", b"0123")
    assert f.local and f.read("a/x") == b"0123" and f.exists("a") and not f.exists("b") and os.listdir(tmp_path / "u" / "a") == ["x"]
    f.remove("a/x")
    assert not f.exists("a/x")


def test_header_json():
    assert filing.header_json({"path": "/é🔴"}) == '{"path":"/\\u00e9\\ud83d\\udd34"}'


def test_entry(spark):
    import __spark_entry__ as e

    assert len(e.entry(spark).columns) == 1 and set(e.oracle_sql()) <= set(e.queries())
