"""The stages as commands.

    python -m lettrine.plans.pipeline ingest [config] [--account A] [--mail-root F]
    python -m lettrine.plans.pipeline parse  [config] [--account A]
    python -m lettrine.plans.pipeline enrich [config] [--account A] [--agents F] [--force] [--limit N] [--dry-run]
    python -m lettrine.plans.pipeline file   [config] [--account A] [--root R] [--force] [--limit N] [--dry-run]
    python -m lettrine.plans.pipeline run    [config]

``ingest`` reads the IMAP account of the configuration, or folders of ``.eml`` files
below ``--mail-root``.  Folders must be mounted by all nodes.  Tables lie below ``<baseFolder>/<parseIaFolder>``: bundles, outputs, failures, archive.
``run`` stops at the first stage that fails.
"""

from __future__ import annotations

import argparse
import logging
import os
import sys
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettrine.plans import enrich, filing, ingest, parse, pdf, spec
from lettrine.sources import config as C
from lettrine.sources import imap, index, mailbox
from lettrine.streaming.ingest import known
from lettrine.workspace import persisted

log = logging.getLogger("lettrine")


class Run:
    def __init__(self, spark: SparkSession, config: C.Config, model_factory: Callable | None = None, store_factory: Callable | None = None, native: pdf.Extractor = pdf.none, ocr: pdf.Extractor = pdf.none):
        self.spark, self.config, self.model_factory, self.store_factory, self.native, self.ocr = spark, config, model_factory, store_factory, native, ocr
        self.work = os.path.join(config.baseFolder, config.parseIaFolder)
        mailbox.register(spark)
        spark.dataSource.register(imap.ImapSource)

    def _table(self, name: str, empty: str) -> DataFrame:
        path = os.path.join(self.work, name)
        return self.spark.read.parquet(path) if os.path.isdir(path) and any(f.endswith(".parquet") for f in os.listdir(path)) else self.spark.createDataFrame([], empty)

    def _failed(self, rows: DataFrame) -> None:
        rows.select("stage", "key", "error").write.mode("append").parquet(os.path.join(self.work, "failures"))

    def accounts(self, only: str | None) -> list[C.Account]:
        return [a for a in self.config.accounts if only is None or a.name == only]

    def _mails(self, a: C.Account, mail_root: Callable[[C.Account], str] | None) -> DataFrame:
        if mail_root is not None:
            return self.spark.read.format("mailbox").option("path", mail_root(a)).option("foldersOut", ",".join(a.foldersOut)).load()
        o = {"host": a.host, "port": a.port, "ssl": str(a.sslEnabled).lower(), "login": a.login, "password": a.password, "account": a.name, "foldersOut": ",".join(a.foldersOut), "foldersIn": ",".join(a.foldersIn)}
        return self.spark.read.format("imap").options(**o).load()

    def ingest(self, mail_root: Callable[[C.Account], str] | None = None, only: str | None = None) -> None:
        """Save the new messages of each account: of its IMAP folders, or of the folder that ``mail_root`` gives for it."""
        state = os.path.join(self.config.baseFolder, "message-index.json")
        for a in self.accounts(only):
            if mail_root is None and not a.host:
                log.warning("account %s has no mail server", a.name)
                continue
            base = os.path.join(self.config.baseFolder, a.name)
            ids = index.load(self.spark, state)
            os.makedirs(base, exist_ok=True)
            disk = self.spark.read.format("mailbox").option("path", self.config.baseFolder).option("skip", self.config.parseIaFolder).option("anyCase", "false").load()
            mails = persisted(self._mails(a, mail_root), "mails")  # fetched once
            rows = ingest.named(ingest.to_save(mails, ids, ingest.headers(disk).select("id"), a.recover), a.groupByContact)
            saved = ingest.save(ingest.with_contents(rows, mails), base).where("error is null").select("id").cache()
            index.export(index.union(ids, saved), state)
            saved.unpersist()

    def parse(self, only: str | None = None) -> None:
        for a in self.accounts(only):
            root = os.path.join(self.config.baseFolder, a.name)
            if not os.path.isdir(root):
                log.warning("no folder for account %s", a.name)
                continue
            files = self.spark.read.format("mailbox").option("path", root).option("skip", self.config.parseIaFolder).option("content", "false").load()
            files = files.withColumn("folder", F.concat_ws("/", F.lit(a.name), F.nullif("folder", F.lit(""))))
            new = persisted(parse.pending(files, known(self.spark, os.path.join(self.work, "bundles"))), "pending")
            rows, failed = parse.bundles(mailbox.contents(new), self.work, self.native, self.ocr)
            rows.withColumn("account_name", F.lit(a.name)).write.mode("append").parquet(os.path.join(self.work, "bundles"))
            self._failed(failed)

    def enrich(self, only: str | None = None, agents: str | None = None, force: bool = False, limit: int | None = None, dry_run: bool = False) -> DataFrame | None:
        if not self.config.aiEnabled:
            log.info("enrichment is off")
            return None
        path = C.agents_path(self.config, agents)
        s = spec.load(path)
        with open(path, encoding="utf-8") as f:
            text = f.read()
        bundles = self.spark.read.parquet(os.path.join(self.work, "bundles"))
        rows = enrich.with_input_hash(enrich.jobs(bundles, [a.name for a in self.accounts(only)], limit), text)
        rows = enrich.outdated(rows, self._table("outputs", "folder string, stem string, position int, input_hash string"), force)
        asked = enrich.requests(rows, s, self.config.aiModel, self.config.aiSendRawImages, self.config.aiMaxAttachmentBytes)
        if dry_run:
            return asked.select(*enrich.KEY, "request")
        outputs, failed = enrich.run(asked, s, self.model_factory or enrich.stub_model(s), self.config.aiRetryCount, self.config.aiRequestDelayMs, self.config.aiRequestDelayMs > 0)
        outputs.write.mode("append").parquet(os.path.join(self.work, "outputs"))
        self._failed(failed)
        return outputs

    def file(self, only: str | None = None, root: str | None = None, limit: int | None = None, dry_run: bool = False) -> DataFrame:
        bundles = enrich.jobs(self.spark.read.parquet(os.path.join(self.work, "bundles")), [a.name for a in self.accounts(only)], limit)
        outputs = self._table("outputs", "folder string, stem string, position int, ai string, completed_at timestamp")
        newest = outputs.groupBy(*enrich.KEY).agg(F.max_by("ai", "completed_at").alias("ai"))
        folder = C.root_folder(self.config, root)
        store = self.store_factory or partial(filing.LocalStore, os.path.join(self.work, "store"))
        plans, failed = filing.file_documents(self.spark, bundles, newest, folder, os.path.join(self.work, "archive"), store, dry_run)
        if not dry_run:
            self._failed(failed)
        return plans


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="lettrine")
    p.add_argument("stage", choices=("ingest", "parse", "enrich", "file", "run"))
    p.add_argument("config", nargs="?")
    for name in ("--account", "--agents", "--root", "--mail-root"):
        p.add_argument(name)
    p.add_argument("--limit", type=int)
    p.add_argument("--force", action="store_true")
    p.add_argument("--dry-run", action="store_true")
    a = p.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    try:
        config = C.load(a.config)
    except (OSError, C.ConfigError) as e:
        log.error("%s", e)
        return 1
    spark = SparkSession.builder.appName("lettrine").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    run = Run(spark, config)
    mails = (lambda account: os.path.join(a.mail_root, account.name)) if a.mail_root else None
    stages = {"ingest": lambda: run.ingest(mails, a.account), "parse": lambda: run.parse(a.account), "enrich": lambda: run.enrich(a.account, a.agents, a.force, a.limit, a.dry_run), "file": lambda: run.file(a.account, a.root, a.limit, a.dry_run)}
    for name in ("ingest", "parse", "enrich", "file") if a.stage == "run" else (a.stage,):
        log.info("stage %s", name)
        stages[name]()
    return 0


if __name__ == "__main__":
    sys.exit(main())
