"""Stage 3: bundles to validated classifications, through an injected model."""

from __future__ import annotations

import json
import time
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettrine.functions import hashes, markup
from lettrine.functions import text as X
from lettrine.operators import dedup, documents, ordering
from lettrine.plans.spec import Spec, cache_key, schema_errors
from lettrine.workspace import persisted

JSON_CHARS = 16_000
PREFIX = "enrich"
#: A document: its message's folder and stem, and its position in the message.
KEY = ["folder", "stem", "position"]
#: A model answers a request; ``request["files"]`` holds (name, bytes) of what it is to look at itself.
Model = Callable[[dict], dict]


class ServiceError(Exception):
    """A failed call: status, body, and the headers that tell how long to wait."""

    def __init__(self, status: int, body: str = "", wait_s: float | None = None):
        super().__init__(f"status {status}: {body[:400].strip() or '<empty body>'}")
        self.status, self.body, self.wait_s = status, body, wait_s

    @property
    def retryable(self) -> bool:
        return self.status in (408, 500, 502, 503, 504) or self.status == 429 and "insufficient_quota" not in self.body


def jobs(bundles: DataFrame, accounts: list[str] | None, limit: int | None) -> DataFrame:
    """Bundles in path order; the limit counts them before any is skipped."""
    rows = bundles.where(F.col("account_name").isin(*accounts)) if accounts else bundles
    if limit is None:
        return rows
    return ordering.placed(rows, [X.path_order("folder"), F.col("stem"), F.col("position")], "place").where(F.col("place") <= limit).drop("place")


def with_input_hash(rows: DataFrame, spec_text: str) -> DataFrame:
    """The hash over the stored bytes of what the model is shown; configuration is not part of it."""
    content = F.when(F.col("content").isNotNull(), F.decode("content", "ISO-8859-1"))
    return rows.withColumn("input_hash", hashes.input_hash(F.col("json"), F.col("xml"), F.lit(spec_text), content))


def outdated(rows: DataFrame, done: DataFrame, force: bool = False) -> DataFrame:
    return rows if force else dedup.not_in(rows, done, [*KEY, "input_hash"])


def requests(rows: DataFrame, spec: Spec, model: str, send_images: bool = False, max_bytes: int = documents.MAX_ATTACHMENT_BYTES) -> DataFrame:
    """Each bundle with its request as JSON. Returned as it is, this is the dry run: nothing is sent."""
    a = F.col("attachments")[0]
    text = F.make_valid_utf8(F.col("content").cast("string"))
    routed = documents.route(a["original_name"], a["is_email_body"], a["extracted_text"], a["extracted_text_method"], a["extracted_text_truncated"], F.col("content").isNotNull(), F.octet_length("content"), text, send_images, max_bytes)
    shown = F.to_json(F.struct("parsing_folder", "email_folder", "email_file_name", "message_id", "subject", "expedition_date", "author", "targets", "cc", "bcc", F.array(F.struct(*(a[c].alias(c) for c in ("original_name", "is_email_body", "mime_type", "size", "md5")))).alias("attachments")))
    taxonomy = F.lit(json.dumps(spec.taxonomy, indent=2, ensure_ascii=False))
    out = rows.withColumn("r", routed)
    inputs = F.to_json(F.array(F.struct(a["original_name"].alias("file_name"), a["mime_type"].alias("mime_type"), a["size"].alias("size"), F.col("r.mode").alias("ingestion_mode"), F.col("r.text").alias("extracted_text"), F.col("r.note").alias("note"))))
    prompt = F.concat(
        F.lit("Account: "), "account_name", F.lit("\nMessage: "), "stem", F.lit("\nFolders:\n"), taxonomy, F.lit("\n\nMetadata:\n"), X.truncate_chars(shown, JSON_CHARS),
        F.lit("\n\nBody:\n"), X.truncate_chars(markup.body_for_prompt("xml"), markup.BODY_CHARS), F.lit("\n\nAttachments:\n"), inputs, F.lit("\n"),
    )
    request = F.struct(F.lit(model).alias("model"), F.lit(spec.instructions).alias("instructions"), prompt.alias("prompt"), F.lit(json.dumps(spec.schema)).alias("schema"), F.lit(cache_key(PREFIX, model, spec.fingerprint)).alias("cache_key"))
    return out.withColumn("request", F.to_json(request)).withColumn("file", F.when(F.col("r.mode") == "raw_file", F.struct(a["original_name"].alias("name"), F.col("content").alias("bytes")))).drop("r")


def answer_of(payload: dict) -> object:
    """The JSON of a response."""
    if isinstance(payload.get("output_text"), str):
        return json.loads(payload["output_text"])
    for item in payload.get("output") or []:
        for c in item.get("content") or []:
            for key in ("text", "arguments"):
                try:
                    return json.loads(c[key])
                except (KeyError, TypeError, ValueError):
                    continue
    raise ValueError("the response holds no JSON")


def problems(value: object, spec: Spec) -> list[str]:
    """Schema first, then the taxonomy."""
    found = schema_errors(value, {k: v for k, v in spec.schema.items()})
    if found:
        return found
    out = []
    for item in value["attachment_summaries"]:
        allowed = spec.taxonomy.get(item["main_folder"])
        if allowed is None:
            return [f"unknown main_folder `{item['main_folder']}`"]
        if item["sub_folder"] not in allowed:
            out.append(f"`{item['sub_folder']}` is no sub_folder of `{item['main_folder']}`; allowed values are: {', '.join(allowed)}")
    return out


def repair_request(request: dict, error: str, current: object) -> dict:
    """The request with the error and the current JSON; files are not sent again."""
    told = f"{request['prompt']}\n\nProblems:\n{error}\n\nCurrent JSON:\n{json.dumps(current, ensure_ascii=False, indent=2)}\n"
    kept = {k: v for k, v in request.items() if k != "files"}
    return kept | {"prompt": told, "cache_key": request["cache_key"] + ":repair"}


class Pacer:
    """The least time between the calls of one task."""

    def __init__(self, delay_s: float, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic):
        self.delay_s, self.sleep, self.clock, self.last = delay_s, sleep, clock, None

    def wait(self) -> None:
        now = self.clock()
        if self.last is not None and now - self.last < self.delay_s:
            self.sleep(self.delay_s - (now - self.last))
        self.last = self.clock()


def call(model: Model, request: dict, retries: int, pacer: Pacer) -> dict:
    for attempt in range(retries + 1):
        pacer.wait()
        try:
            return model(request)
        except ServiceError as e:
            if not e.retryable or attempt == retries:
                raise
            pacer.sleep(e.wait_s if e.wait_s is not None else attempt + 1)
    raise AssertionError


def enrich_one(model: Model, request: dict, spec: Spec, retries: int, pacer: Pacer) -> object:
    """A valid answer, after at most ``retries`` repairs."""
    value = answer_of(call(model, request, retries, pacer))
    for _ in range(retries):
        found = problems(value, spec)
        if not found:
            return value
        value = answer_of(call(model, repair_request(request, "; ".join(found), value), retries, pacer))
    found = problems(value, spec)
    if found:
        raise ValueError("; ".join(found))
    return value


def run(rows: DataFrame, spec: Spec, model_factory: Callable[[], Model], retries: int = 2, delay_ms: int = 0, one_at_a_time: bool = False) -> tuple[DataFrame, DataFrame]:
    """(outputs, failures) of rows with ``request``. A failed job is a row, not a failed run.

    Calls have effects outside, so the answers are written before they are read.
    ``one_at_a_time`` keeps the delay over the whole run, in a single task.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, pacer = model_factory(), Pacer(delay_ms / 1000)
        for batch in batches:
            asked = batch.column("request").to_pylist()
            answers: list[str | None] = []
            errors: list[str | None] = []
            for text, file in zip(asked, batch.column("file"), strict=True):
                try:
                    request = json.loads(text)
                    if (f := file.as_py()) is not None:
                        request["files"] = [(f["name"], f["bytes"])]
                    answers.append(json.dumps(enrich_one(model, request, spec, retries, pacer), ensure_ascii=False))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - the error is the result
                    answers.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(answers, pa.string()), pa.array(errors, pa.string())], names=[*KEY, "input_hash", "ai", "error"])

    file = F.col("file") if "file" in rows.columns else F.lit(None).cast("struct<name:string,bytes:binary>").alias("file")
    asked = rows.select(*KEY, "input_hash", "request", file)
    done = persisted((asked.coalesce(1) if one_at_a_time else asked).mapInArrow(each, "folder string, stem string, position int, input_hash string, ai string, error string"), "answers")
    outputs = done.where("error is null").drop("error").withColumn("completed_at", F.current_timestamp())
    failures = done.where("error is not null").select(F.lit("enrich").alias("stage"), F.concat_ws("/", "folder", "stem", F.col("position").cast("string")).alias("key"), "error", F.current_timestamp().alias("failed_at"))
    return outputs, failures


def remote_model(key: str, base: str, transport: Callable[[str, str, dict[str, str], bytes], tuple[int, bytes]]) -> Callable[[], Model]:
    """A model behind an HTTP service: files are uploaded first and named in the request by their ids."""

    def ask(path: str, headers: dict[str, str], body: bytes) -> dict:
        status, answer = transport("POST", f"{base.rstrip('/')}/{path}", {"Authorization": f"Bearer {key}"} | headers, body)
        if not 200 <= status < 300:
            raise ServiceError(status, answer.decode("utf-8", "replace"))
        return json.loads(answer)

    def upload(name: str, data: bytes) -> str:
        mark = f"part-{zlib.crc32(data):08x}-{len(data)}"
        shown = name.replace('"', "%22").replace("\r", " ").replace("\n", " ")
        body = f'--{mark}\r\nContent-Disposition: form-data; name="purpose"\r\n\r\nuser_data\r\n--{mark}\r\nContent-Disposition: form-data; name="file"; filename="{shown}"\r\n\r\n'.encode() + data + f"\r\n--{mark}--\r\n".encode()
        return ask("files", {"Content-Type": f"multipart/form-data; boundary={mark}"}, body)["id"]

    def factory() -> Model:
        def model(request: dict) -> dict:
            content = [{"type": "input_text", "text": request["prompt"]}, *({"type": "input_file", "file_id": upload(n, d)} for n, d in request.get("files", ()))]
            form = {"type": "json_schema", "name": PREFIX, "strict": True, "schema": json.loads(request["schema"])}
            asked = {"model": request["model"], "instructions": request["instructions"], "input": [{"role": "user", "content": content}], "text": {"format": form}, "prompt_cache_key": request["cache_key"]}
            return ask("responses", {"Content-Type": "application/json"}, json.dumps(asked).encode())

        return model

    return factory


def stub_model(spec: Spec) -> Callable[[], Model]:
    """A model without a network: the first folders, importance by length of the prompt."""
    main = next(iter(spec.taxonomy))

    def factory() -> Model:
        def model(request: dict) -> dict:
            names = [a["file_name"] for a in json.loads(request["prompt"].rsplit("Attachments:\n", 1)[1].split("\n")[0])]
            level = "HAUTE" if len(request["prompt"]) % 2 else "BASSE"
            items = [{"file_name": n, "mime_type": None, "summary": n, "importance": level, "proposed_file_name": f"2024-01-01 {zlib.crc32(request['prompt'].encode()):08x} {n}", "main_folder": main, "sub_folder": spec.taxonomy[main][0]} for n in names]
            return {"output_text": json.dumps({"email_summary": "stub", "email_importance": level, "attachment_summaries": items})}

        return model

    return factory


def columns(ai: Column) -> Column:
    from lettrine.schemas import CLASSIFICATION

    return F.from_json(ai, CLASSIFICATION)
