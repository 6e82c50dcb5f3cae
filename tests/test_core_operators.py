import json

import pytest
from pyspark.sql import functions as F

from lettrine import workspace
from lettrine.operators import dedup, documents, ordering, shred, upsert
from tests.conftest import SMALL

# ------------------------------------------------------------------ shredding


def links(payload):
    """Brute force: the links of a payload, recursively."""
    try:
        root = json.loads(payload) if payload else None
    except ValueError:
        return set()
    out = set()

    def walk(m, at):
        for f in ("targets", "cc", "attachments"):
            v = m.get(f)
            if isinstance(v, str):
                try:
                    v = json.loads(v)
                except ValueError:
                    continue
            for i, x in enumerate(v if isinstance(v, list) else [v]):
                if isinstance(x, dict):
                    p = f"{at}.{f}[{i}]"
                    out.add((at, p))
                    if f == "attachments" and isinstance(x.get("embedded"), dict):
                        out.add((p, p + ".embedded"))
                        walk(x["embedded"], p + ".embedded")

    if isinstance(root, dict):
        walk(root, "$")
    return out


def test_links_of_all_payloads(spark):
    raw = spark.read.parquet(f"{SMALL}/raw_bundles.parquet")
    wanted = {(r["raw_id"], *x) for r in raw.collect() for x in links(r["payload"])}
    got = shred.parent_links(shred.shred(raw)).collect()
    assert len(got) == len(wanted) and {tuple(r) for r in got} == wanted


def test_entities_hold_their_scalars(spark):
    record = {"message_id": "m", "author": {"raw": "A"}, "targets": {"raw": "T", "name": None, "address": "t@x"}, "cc": None, "attachments": ['x', None, {"size": "12", "embedded": {"subject": "s", "cc": '[{"raw": "C"}]'}}]}
    rows = [(1, json.dumps(record), "x"), (1, json.dumps(record), "x"), (2, None, "x"), (3, "{broken", "x"), (4, "[]", "x"), (5, '{"targets": 3, "attachments": "text"}', "x"), (6, '{"a": "\\ud83d"}', "x"), (7, "", "x")]
    n = shred.shred(spark.createDataFrame(rows, "raw_id long, payload string, path string"))
    contacts = {(r["raw_id"], r["path"]): (r["field"], r["raw"], r["name"], r["address"]) for r in shred.contacts(n).collect()}
    assert contacts == {(1, "$.author"): ("author", "A", None, None), (1, "$.targets[0]"): ("targets", "T", None, "t@x"), (1, "$.attachments[2].embedded.cc[0]"): ("cc", "C", None, None)}
    assert [(r["path"], r["size"]) for r in shred.attachments(n).collect()] == [("$.attachments[2]", "12")]
    assert {(r["raw_id"], r["path"], r["subject"]) for r in shred.messages(n).collect()} == {(1, "$", None), (1, "$.attachments[2].embedded", "s"), (5, "$", None), (6, "$", None)}


def test_deep_and_empty(spark):
    deep = '{"a":' * 3000 + "1" + "}" * 3000
    n = shred.shred(spark.createDataFrame([(1, deep)], "raw_id long, payload string"))
    assert shred.messages(n).count() == 1
    assert shred.parent_links(shred.shred(spark.createDataFrame([], "raw_id long, payload string"))).count() == 0


# ------------------------------------------------------------------ upsert


def test_surplus_copies(spark):
    rows = [(1, " <a@x> ", "2024-01-02"), (2, "a@x", "2024-01-01"), (3, "a@x", "2024-01-01"), (4, None, "2024-01-01"), (5, " ", "2024-01-01"), (6, "<k@x>", "2024-01-01"), (7, "b@x", None), (8, "b@x", "2025-01-01"), (8, "b@x", "2025-01-01")]
    d = spark.createDataFrame(rows, "record_id long, message_id string, at string").withColumn("delivered_at", F.to_timestamp("at"))
    i = spark.createDataFrame([(["k@x", "k@x", None, ""],), ([],), (None,)], "message_ids array<string>")
    assert sorted(r[0] for r in upsert.surplus_copies(d, i).collect()) == [1, 3, 6, 7]
    assert sorted(r[0] for r in upsert.deduplicated(d, i).select("record_id").distinct().collect()) == [2, 4, 5, 8]
    assert upsert.surplus_copies(d.limit(0), i).count() == 0
    assert sorted(r[0] for r in upsert.surplus_copies(d, i.limit(0)).collect()) == [1, 3, 7]


def test_upsert_is_idempotent_and_compaction_needs_no_shuffle(spark):
    store = upsert.RunStore(spark, buckets=4)
    run = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5), (None, 1)], "id string, v int").select("id", F.struct("v").alias("version"))
    store.upsert(run)
    once = sorted((r["id"], r["version"]["v"]) for r in store.compacted().collect())
    store.upsert(run)
    assert once == sorted((r["id"], r["version"]["v"]) for r in store.compacted().collect()) == [("a", 1), ("b", 5)]
    plan = store.compacted()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    new = store.compact()
    assert new.compacted().count() == 2 and not workspace.exists(spark, store.path)
    # the next batch opens the store again
    new.close()
    again = upsert.RunStore(spark, buckets=9, path=new.path)
    assert again.buckets == 4 and not again.empty
    again.upsert(spark.createDataFrame([("a", 0), ("b", 9), ("c", 7)], "id string, v int").select("id", F.struct("v").alias("version")))

    def shown(s):
        assert "Exchange" not in s.compacted()._jdf.queryExecution().executedPlan().toString()
        return sorted((r["id"], r["version"]["v"]) for r in s.compacted().collect())

    assert shown(again) == [("a", 0), ("b", 5), ("c", 7)]
    last = again.compact(f"{new.path}-2")
    assert shown(last) == [("a", 0), ("b", 5), ("c", 7)] and not workspace.exists(spark, new.path)
    last.remove()
    assert not workspace.exists(spark, last.path) and upsert.RunStore(spark, path=last.path).empty


# ------------------------------------------------------------------ dedup


def test_first_wins(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), (None, 3, "c"), (None, 4, "d"), ("", 5, "e")], "md5 string, n int, v string")
    assert {tuple(r) for r in dedup.first_wins(df, "md5", [F.col("n")]).collect()} == {("k", 1, "a"), (None, 3, "c"), ("", 5, "e")}
    assert dedup.first_wins(df.limit(0), "md5", [F.col("n")]).count() == 0
    assert [r["rank"] for r in dedup.ranked(df.where("md5 = 'k'"), "md5", ["n"]).orderBy("n").collect()] == [1, 2]


def test_sticky_names(spark):
    df = spark.createDataFrame([("e", " ", 1), ("e", "A", 2), ("e", "B", 3), ("f", None, 1)], "email string, name string, seq int")
    assert [tuple(r) for r in dedup.sticky_name(df, "email", "name", "seq").select("email", "seq", "sticky_name").orderBy("email", "seq").collect()] == [("e", 1, ""), ("e", 2, "A"), ("e", 3, "A"), ("f", 1, "")]


def test_collisions_have_a_second_pass(spark):
    df = spark.createDataFrame([("f", "a.pdf", 1), ("f", "a.pdf", 2), ("f", "a_1.pdf", 3), ("g", "a.pdf", 4), ("f", ".x", 5), ("f", ".x", 6)], "folder string, name string, n int")
    got = {r["n"]: r["unique_name"] for r in dedup.number_collisions(df, "folder", "name", ["n"]).collect()}
    assert got[1] == "a.pdf" and got[4] == "a.pdf" and got[6] == ".x_1"
    assert len({got[1], got[2], got[3]}) == 3


@pytest.mark.parametrize(("recover", "wanted"), [(False, {3}), (True, {2, 3, 4})])
def test_recover(spark, recover, wanted):
    m = spark.createDataFrame([("held", 1), ("lost", 2), ("new", 3), ("lost", 4)], "id string, n int")
    index, disk = (spark.createDataFrame([(x,) for x in ids], "id string") for ids in (["held", "lost"], ["held"]))
    assert {r["n"] for r in dedup.new_or_recoverable(m, index, disk, recover).collect()} == wanted


def test_places(spark):
    df = spark.range(1000).withColumn("k", F.abs(F.xxhash64("id")))
    got = [(r["place"], r["k"]) for r in ordering.placed(df, [F.col("k")]).orderBy("place").collect()]
    assert [p for p, _ in got] == list(range(1, 1001)) and [k for _, k in got] == sorted(k for _, k in got)


def test_anti_join_reads_only_the_key(spark):
    df = spark.createDataFrame([("x",)], "md5 string")
    plan = dedup.not_in(df, spark.read.parquet(f"{SMALL}/dropbox_uploads.parquet"), ["md5"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<md5:string>" in plan


# ------------------------------------------------------------------ documents


def test_bundles(spark):
    names = ["a.json", "a.xml", "a.pdf", "a.docx", "b.json", "c.json", "c.xml", "c.ai.json.ai.json", "c.ai.meta.json"]
    listing = spark.createDataFrame([("f", n) for n in names], "folder string, name string")
    assert {tuple(r) for r in documents.bundles(listing).collect()} == {("f", "a", "a.json", "a.xml", None, "a.pdf"), ("f", "c", "c.json", "c.xml", "c.ai.json.ai.json", None)}
    assert [r["stem"] for r in documents.bundles(listing, need_ai=True).collect()] == ["c"]


def test_folder_issues(spark):
    items = F.array(F.struct(F.lit("f.pdf").alias("file_name"), F.lit("A").alias("main_folder"), F.lit("NO").alias("sub_folder")))
    tax = F.create_map(F.lit("A"), F.array(F.lit("LEGAL"), F.lit("LOCATION")))
    r = spark.range(1).select(documents.folder_issues(items, tax).alias("r")).first()["r"]
    assert r["error"] is None and r["issues"].endswith("allowed values are: LEGAL, LOCATION")


def test_legacy_folders(spark):
    items = F.array(F.struct(F.lit("").alias("main_folder"), F.lit(None).cast("string").alias("sub_folder")))
    r = spark.range(1).select(documents.inherit_folders(items, F.lit("M"), F.lit("S"))[0].alias("i")).first()["i"]
    assert (r["main_folder"], r["sub_folder"]) == ("", "S")


def test_plan(spark):
    schema = "source_file_name string, is_email_body boolean, md5 string, parsed_mime string, expedition_date string, xml_content string, ai_content string, item struct<file_name:string,mime_type:string,summary:string,importance:string,proposed_file_name:string,main_folder:string,sub_folder:string>"
    rows = [
        ("source.pdf", None, "abc", "application/pdf", "2023-03-15T12:34:56+00:00", "<email-content></email-content>", "{}", ("f", None, "s", "HAUTE", "2024-03-15 techvalley fin-contrat", "A", "B")),
        ("email-body.xml", True, "h", "application/xml", "2026-11-17T10:00:00Z", "<email-content></email-content>", "{}", ("f", None, "s", "HAUTE", "2026-11-17 alice engagement.pdf", "A", "B")),
        ("x.pdf", None, "z", "application/pdf", None, "", "", ("f", None, "s", "HAUTE", "x", None, "B")),
    ]
    got = documents.plan(spark.createDataFrame(rows, schema), "/Archives").collect()
    assert got[0]["dropbox_path"] == "/Archives/A_TRAITER/2024-03-15 techvalley fin-contrat.pdf" and got[0]["xml_dropbox_path"].endswith("fin-contrat.xml") and not got[0]["xml_only"]
    assert got[1]["xml_only"] and got[1]["dropbox_path"] == got[1]["xml_dropbox_path"] == "/Archives/A_TRAITER/2026-11-17 alice engagement.xml" and got[1]["year_folder"] == "2026"
    assert got[2]["error"] == "missing folder" and got[0]["error"] is None
