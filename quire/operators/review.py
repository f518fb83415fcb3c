"""The two-pass reviews as compositions of the operators (the reference's main flows).

The model is outside: a flow returns the request tables it would send, and consumes answer tables with columns
``(path, response, aseq)`` that an external service, or a ``mapInPandas`` client, produced.  Requests are known by
their file path, so files that claim the same number do not share an answer; ``aseq`` orders repeated answers and
the last one wins.  A file whose answer has not come is recorded as ``retry`` and asked again by the next run.
Every step is a DataFrame operator, so the run is one set of Spark jobs over the whole input rather than a loop over
chunks.  Request templates are the caller's.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire import schemas
from quire.functions.text import is_sentinel
from quire.operators import documents as D
from quire.operators import extract as X
from quire.operators import results as R
from quire.operators import sync


@dataclass(frozen=True)
class Template:
    """What stands before and after the text of a request."""

    head: str = ""
    tail: str = ""


def first_pass(files: DataFrame, processed: DataFrame, texts: DataFrame, template: Template = Template(),
               path: str = "path") -> dict[str, DataFrame]:
    """Files not processed yet, their status (``ok`` / ``no_text``) and the pass-1 requests of ``ok`` files."""
    todo = R.unprocessed(files.select(path), processed, key=path)
    docs = D.drop_empty_text(todo.join(texts.select(path, "text"), path, "left"))
    requests = docs.where(F.col("status") == "ok").select(
        path, X.build_request("text", template.head, template.tail).alias("request_text"))
    return {"todo": docs.select(path, "status"), "requests": requests}


def last_answers(answers: DataFrame, path: str = "path", seq: str = "aseq") -> DataFrame:
    """The last answer of each request that has one (a null response is no answer)."""
    return answers.where(F.col("response").isNotNull()).groupBy(path).agg(F.max_by("response", seq).alias("response"))


def ledger_rows(todo: DataFrame, records: DataFrame, path: str = "path") -> DataFrame:
    """Processed-ledger rows: ``no_text``, ``retry`` (asked, not answered), ``error`` (unusable answer) or ``ok``."""
    answered = records.select(path, F.when(F.col("is_error"), "error").otherwise("ok").alias("_answer"))
    return todo.join(answered, path, "left").select(path, F.when(F.col("status") == "no_text", "no_text").otherwise(
        F.coalesce("_answer", F.lit("retry"))).alias("status"))


def contract_second_pass(results: DataFrame, answers: DataFrame, template: Template = Template(),
                         path: str = "file_path") -> dict[str, DataFrame]:
    """Second pass over existing results (all rows, or a run of its own over a loaded table): ``requests2`` with the
    context of each row, and ``results`` with the answers' status and reason, in review order."""
    rows = R.backfill_columns(results, schemas.CONTRACT_RESULT, schemas.CONTRACT_DEFAULTS,
                              fill=("first_pass_reason", "second_pass_reason")).drop("seq")
    requests = R.context_text(rows, seq=path).select(path, "contract_number", X.build_request(
        "context_text", template.head, template.tail).alias("request_text"))
    ans = X.decode_response(answers, "response", X.CONTRACT_PASS2).withColumnRenamed("path", "request_id")
    final = R.attach_second_pass(rows, ans, key=path)
    return {"results": R.order_by_status(final, seq=path), "requests2": requests}


def contract_review(files: DataFrame, processed: DataFrame, reviewed: DataFrame, texts: DataFrame, answers1: DataFrame,
                    answers2: DataFrame, run_date: str, template1: Template = Template(),
                    template2: Template = Template(), path: str = "path") -> dict[str, DataFrame]:
    """Run both passes.  Returns ``results`` (ordered for review), ``requests1`` / ``requests2`` (what goes
    to the model), ``processed_rows`` (ledger rows, see ``ledger_rows``), ``reviewed_rows`` (new review-ledger rows)
    and ``manifest`` (archive destinations).  Row order is the file path."""
    p1 = first_pass(files, processed, texts, template1, path)
    answered = last_answers(answers1, path).join(p1["requests"].select(path), path, "left_semi")
    rec = (X.decode_response(answered, "response", X.CONTRACT_PASS1)
           .withColumn("file_path", F.col(path)).drop("response"))
    kept = R.skip_reviewed(rec, reviewed)
    second = contract_second_pass(kept.drop(path, "is_error"), answers2, template2)
    return {**second, "requests1": p1["requests"], "processed_rows": ledger_rows(p1["todo"], rec, path),
            "reviewed_rows": R.new_ledger_rows(kept, reviewed, run_date),
            "manifest": sync.archive_manifest(kept, "contract_number", seq="file_path")}


MEMO_UPSERT_COLUMNS = ["second_pass_violations", "second_pass_score", "suggested_remediation", "priority_level"]


def memo_second_pass(results: DataFrame, answers: DataFrame, flag_score: int = 5, path: str = "file_path") -> dict[str, DataFrame]:
    """Second pass over existing memo results: the answers' columns by memo id (last answer wins, sentinels never
    match), flags (score >= ``flag_score`` or priority high), priority order, archive manifest of the flagged."""
    rows = R.backfill_columns(results, schemas.MEMO_RESULT, schemas.MEMO_DEFAULTS).drop("seq")
    ans = (X.decode_response(answers, "response", X.MEMO_PASS2)
           .select("memo_id", *MEMO_UPSERT_COLUMNS, F.struct("aseq", "path").alias("useq")))
    merged = R.upsert_results(rows, ans, key="memo_id", seq="useq", columns=MEMO_UPSERT_COLUMNS)
    flagged = (~is_sentinel("memo_id")) & (
        (F.col("first_pass_non_compliance_score") >= F.lit(flag_score)) | (F.lower("priority_level") == "high"))
    marked = merged.withColumn("flagged", F.coalesce(flagged, F.lit(False)))
    return {"results": R.order_by_priority(marked, seq=path),
            "manifest": sync.archive_manifest(marked.where("flagged"), "memo_id", seq=path),
            "flag_counts": R.flag_counts(marked, schemas.MEMO_FLAGS),
            "priorities": R.status_distribution(marked, ["priority_level"])}


def memo_review(files: DataFrame, processed: DataFrame, known: DataFrame, texts: DataFrame, answers1: DataFrame,
                answers2: DataFrame, run_date: str, flag_score: int = 5, template1: Template = Template(),
                template2: Template = Template(), path: str = "path") -> dict[str, DataFrame]:
    """Memo flow: pass 1, memos whose id is already known are skipped, pass 2 on the text of the rest.  Returns what
    ``memo_second_pass`` returns, the requests of both passes, the processed-ledger rows and the new rows of the
    ledger of memo ids."""
    p1 = first_pass(files, processed, texts, template1, path)
    answered = last_answers(answers1, path).join(p1["requests"].select(path), path, "left_semi")
    rec = (X.decode_response(answered, "response", X.MEMO_PASS1)
           .withColumn("file_path", F.col(path)).drop("response"))
    kept = R.skip_reviewed(rec, known, "memo_id")
    requests2 = kept.join(texts.select(path, "text"), path).select(
        path, "memo_id", X.build_request("text", template2.head, template2.tail).alias("request_text"))
    ans = last_answers(answers2, path).join(kept.select(path), path, "left_semi").withColumn("aseq", F.lit(0))
    second = memo_second_pass(kept.drop(path, "is_error"), ans, flag_score)
    return {**second, "requests1": p1["requests"], "requests2": requests2,
            "processed_rows": ledger_rows(p1["todo"], rec, path),
            "ledger_rows": R.new_ledger_rows(kept, known, run_date, key="memo_id")}
