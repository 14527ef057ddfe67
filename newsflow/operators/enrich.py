"""Enrichment: prompts, batched model calls with per-row fallback, finalisers
and the raw -> ready | error status machine.

Prompts and every post-processing step are native Column expressions; only
the model call runs in Python (``mapInPandas``), batched per Arrow batch.
The model is injected: ``generate(requests) -> answers`` where ``requests``
is a pandas DataFrame (uid, kind, prompt) and the result is a DataFrame
(text, error) of the same length -- ``error`` is the failure message (or
None).  An empty answer and one of the wrong type count as failures of the
call; the row falls back to plain texts and is ready all the same.

Status 'error' is for failures outside the model: a landed row whose fields
have the wrong type or no key is never sent to the model, and a row that its
answers make larger than the store takes is never written.  Either gets an
error patch with the reason in ``processing_error``; the other rows go on.

With an answer table (``answers``), every answer is kept under (uid, kind, digest
of the prompt) as soon as its task ends, and asked for only once: a run that died
repeats no call of a finished task.
"""

from __future__ import annotations

import re
from typing import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.functions.text import py_strip, truncate
from newsflow.session import bound_batches, ship_package, stage

# Output limits and the fallback / finaliser texts.
ONE_LINE_MAX = 140          # cut applied to the model's one-line summary
FALLBACK_TITLE_MAX = 120    # cut applied to the title in fallback mode
TG_FALLBACK_PREFIX = "📰 "
TG_FALLBACK_LINK = "\n\n🔗 "
IG_FALLBACK_PREFIX = "🎬 "
IG_FALLBACK_SOURCE = "\n\nSource: "
TG_SOURCE_LABEL = "সূত্র: "

KINDS = ("one_line", "telegram", "instagram")
#: Most bytes of text that the store takes in one row.
STORE_ROW_BYTES = 1 << 20
#: Text fields of a landed row, in the order in which they are checked.
TEXT_FIELDS = ["title", "raw_summary", "full_text", "url", "source", "feed_url", "media_url", "published_raw", "published_at"]

Generate = Callable[[pd.DataFrame], pd.DataFrame]


def _v(c) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


# Prompt templates (own wording; same fields and limits as the reference's
# instructions).  ``{name}`` slots are filled with ``x or ''`` of the field.
PROMPT_TEMPLATES = {
    "one_line": (
        "TASK: headline digest of one news item.\n"
        "LIMITS: single line; 120 characters at most; language of the title; plain text; given facts only.\n\n"
        "Title: {title}\nSummary: {summary}\n"),
    "telegram": (
        "TASK: channel post about one news item.\n"
        "LIMITS: two or three lines, the first like a headline and the last leading to the link; "
        "no more than two emoji; link kept verbatim; given facts only. Source and link follow separately.\n\n"
        "Title: {title}\nSummary: {summary}\nSource: {source}\nLink: {url}\n"),
    "instagram": (
        "TASK: picture caption about one news item.\n"
        "LIMITS: three to six lines; three to six emoji; five to seven hashtags at the end; "
        "the source named in passing.\n\n"
        "Title: {title}\nSummary: {summary}\nSource: {source}\n"),
}


def template_parts(kind: str) -> list[tuple[str, str]]:
    """Template as a list of ("lit", text) / ("field", name) pieces."""
    out = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", PROMPT_TEMPLATES[kind])):
        if piece:
            out.append(("field" if i % 2 else "lit", piece))
    return out


def build_prompt(kind: str, **fields) -> Column:
    return F.concat(*[F.lit(v) if t == "lit" else _v(fields[v]) for t, v in template_parts(kind)])


def prompt_one_line(title, summary) -> Column:
    return build_prompt("one_line", title=title, summary=summary)


def prompt_telegram(title, summary, source, url) -> Column:
    return build_prompt("telegram", title=title, summary=summary, source=source, url=url)


def prompt_instagram(title, summary, source) -> Column:
    return build_prompt("instagram", title=title, summary=summary, source=source)


def with_prompts(items: DataFrame) -> DataFrame:
    """Store rows -> + three prompt columns (fields read as ``x or ''``)."""
    return items.withColumns({
        "prompt_one_line": prompt_one_line("title", "raw_summary"),
        "prompt_telegram": prompt_telegram("title", "raw_summary", "source", "url"),
        "prompt_instagram": prompt_instagram("title", "raw_summary", "source"),
    })


def typed_rows(landed: DataFrame, document: str = "document") -> DataFrame:
    """Landed rows (uid, a JSON document) -> uid, the text fields, ``processing_error``.

    A document that is no JSON object, or a field that is neither text nor null,
    makes the row invalid (the first such field in ``TEXT_FIELDS`` order is named);
    its other text fields are kept.
    """
    v = landed.select("uid", F.try_parse_json(document).alias("v"))
    kind = {f: F.schema_of_variant(F.variant_get("v", f"$.{f}", "variant")) for f in TEXT_FIELDS}
    wrong = [F.when(~kind[f].isin("STRING", "VOID"), F.concat(
        F.lit(f"{f} must be text, got "), F.lower(F.regexp_extract(kind[f], "^[A-Z]+", 0)))) for f in TEXT_FIELDS]
    whole = F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False))
    problem = F.when(~whole, F.lit("document must be a JSON object")).otherwise(F.coalesce(*wrong))
    text = [F.when(whole & (kind[f] == "STRING"), F.variant_get("v", f"$.{f}", "string")).alias(f) for f in TEXT_FIELDS]
    return v.select("uid", *text, problem.alias("processing_error"))


def text_bytes(*columns) -> Column:
    """UTF-8 bytes of some texts together."""
    total = F.lit(0).cast("long")
    for c in columns:
        total = total + F.coalesce(F.octet_length(c), F.lit(0))
    return total


def _requests(items: DataFrame) -> DataFrame:
    """The prompts, what rules a row out before any call, and its size as stored."""
    problem = F.when(_v("uid") == "", F.lit("uid is missing"))
    if "processing_error" in items.columns:
        problem = F.coalesce(F.nullif("processing_error", F.lit("")), problem)
    size = text_bytes(*(f for f in ["uid", *TEXT_FIELDS] if f in items.columns))
    return (with_prompts(items.withColumns({"processing_error": problem, "row_bytes": size}))
            .select("uid", "title", "source", "url", "processing_error", "row_bytes", *(f"prompt_{k}" for k in KINDS)))


CALL_SCHEMA = T.StructType([
    T.StructField("uid", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("text_one_line", T.StringType()),
    T.StructField("text_telegram", T.StringType()),
    T.StructField("text_instagram", T.StringType()),
    T.StructField("model_error", T.StringType()),
    T.StructField("failed_call", T.IntegerType()),
    T.StructField("processing_error", T.StringType()),
    T.StructField("n_calls", T.IntegerType()),
    T.StructField("row_bytes", T.LongType()),
])
ANSWER_SCHEMA = "uid string, digest string, text string, error string, run string"


def _answers(generate: Generate, req: pd.DataFrame) -> list[tuple]:
    """(text, error) of each request; when a batch fails its rows are asked one
    by one, so a failure stays with its row."""
    try:
        ans = generate(req)
        if len(ans) != len(req):
            raise ValueError(f"model returned {len(ans)} answers for {len(req)} prompts")
        return list(zip(ans["text"], ans["error"]))
    except Exception as e:  # noqa: BLE001 - the whole call failed
        if len(req) == 1:
            return [(None, str(e))]
        return [a for i in range(len(req)) for a in _answers(generate, req.iloc[i:i + 1].reset_index(drop=True))]


def _checked(answers: list[tuple]) -> list[tuple]:
    """(stripped text, None) or (None, failure) of each answer."""
    out = []
    for text, e in answers:
        if e is None and not (text is None or isinstance(text, str)):
            e = f"answer must be text, got {type(text).__name__}"
        if e is None and not text:
            e = "Empty model response"
        out.append((None, e) if e is not None else (text.strip(), None))
    return out


def _call_batches(generate: Generate):
    def run(it):
        for pdf in it:
            n = len(pdf)
            texts = {k: [None] * n for k in KINDS}
            err, failed, calls = [None] * n, [None] * n, [0] * n
            alive = [i for i, e in enumerate(pdf["processing_error"]) if e is None]
            for step, kind in enumerate(KINDS, start=1):
                if not alive:
                    break
                req = pd.DataFrame({"uid": pdf["uid"].iloc[alive].values,
                                    "kind": kind,
                                    "prompt": pdf["prompt_" + kind].iloc[alive].values})
                nxt = []
                for i, (text, e) in zip(alive, _checked(_answers(generate, req))):
                    calls[i] += 1
                    if e is not None:
                        err[i], failed[i] = e, step
                        continue
                    texts[kind][i] = text
                    nxt.append(i)
                alive = nxt
            yield pd.DataFrame({"uid": pdf["uid"].values, "title": pdf["title"].values,
                                "source": pdf["source"].values, "url": pdf["url"].values,
                                "text_one_line": texts["one_line"],
                                "text_telegram": texts["telegram"],
                                "text_instagram": texts["instagram"],
                                "model_error": err, "failed_call": failed,
                                "processing_error": pdf["processing_error"].values, "n_calls": calls,
                                "row_bytes": pdf["row_bytes"].values},
                               columns=CALL_SCHEMA.fieldNames()).astype(
                {"failed_call": "Int32", "n_calls": "Int32"})
    return run


def call_model(items: DataFrame, generate: Generate, partitions: int | None = None) -> DataFrame:
    """Run the three calls per row (later calls only after earlier ones
    succeeded).  ``partitions`` bounds the number of concurrent callers."""
    req = _requests(items)
    if partitions:
        req = req.repartition(partitions)
    ship_package(items.sparkSession)
    bound_batches(items.sparkSession)
    return req.mapInPandas(_call_batches(generate), CALL_SCHEMA)


def read_answers(spark: SparkSession, answers: str, kind: str) -> DataFrame:
    """(uid, digest, text, error, run): the first kept answer of every request of a kind."""
    path = f"{answers}/kind={kind}"
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], ANSWER_SCHEMA)
    held = spark.read.schema(ANSWER_SCHEMA).parquet(path)
    first = held.groupBy("uid", "digest").agg(F.min(F.struct("run", "error", "text")).alias("a"))
    return first.select("uid", "digest", "a.text", "a.error", "a.run")


def call_model_once(items: DataFrame, generate: Generate, answers: str, run: str = "", partitions: int | None = None) -> DataFrame:
    """:func:`call_model` over an append-only table of answers in the folder ``answers``.

    Each kind of request is anti-joined with the kept answers, the rest is asked and
    appended, and all answers are read back.  Files appear as their tasks end (commit
    by task), so a run that dies keeps what its finished tasks asked; a repeated answer
    of a repeated task counts once.  ``run`` names the run in the table; ``partitions``
    bounds the callers and, with it, what a death can repeat.
    """
    spark = items.sparkSession
    ship_package(spark)
    bound_batches(spark)
    req = stage(_requests(items), "requests")
    out, alive = req, req.where("processing_error is null")
    error, failed, calls = F.lit(None).cast("string"), F.lit(None).cast("int"), F.lit(0)
    for step, kind in enumerate(KINDS, start=1):
        asked = alive.select("uid", F.col(f"prompt_{kind}").alias("prompt"), F.sha2(f"prompt_{kind}", 256).alias("digest"))
        todo = asked.join(read_answers(spark, answers, kind).select("uid", "digest"), ["uid", "digest"], "left_anti")
        if partitions:
            todo = todo.repartition(partitions)

        def ask(it, kind=kind):
            for pdf in it:
                got = _checked(_answers(generate, pd.DataFrame({"uid": pdf["uid"], "kind": kind, "prompt": pdf["prompt"]}))) if len(pdf) else []
                yield pd.DataFrame({"uid": pdf["uid"], "digest": pdf["digest"], "text": [t for t, _ in got],
                                    "error": [e for _, e in got], "run": run})
        (todo.mapInPandas(ask, ANSWER_SCHEMA).write.mode("append")
         .option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(f"{answers}/kind={kind}"))
        got = asked.select("uid", "digest").join(read_answers(spark, answers, kind), ["uid", "digest"]).select(
            "uid", F.col("text").alias(f"text_{kind}"), F.col("error").alias(f"error_{kind}"))
        got = stage(got, f"answers-{kind}")
        out = out.join(got, "uid", "left")
        alive = alive.join(got.where(f"error_{kind} is null").select("uid"), "uid", "left_semi")
        bad = F.col(f"error_{kind}")
        error, failed = F.coalesce(error, bad), F.coalesce(failed, F.when(bad.isNotNull(), step))
        calls = calls + F.when(bad.isNotNull() | F.col(f"text_{kind}").isNotNull(), 1).otherwise(0)
    return out.withColumns({"model_error": error, "failed_call": failed, "n_calls": calls}).select(*CALL_SCHEMA.fieldNames())


def telegram_finalize(body, source, url) -> Column:
    """body stripped; append the source line if the source is not already in
    the body, then the URL if it is not in the body; join with newlines."""
    b = py_strip(body)
    s, u = _v(source), _v(url)
    add_src = F.when((s != "") & (F.instr(b, s) == 0), F.concat(F.lit(TG_SOURCE_LABEL), s))
    add_url = F.when((u != "") & (F.instr(b, u) == 0), u)
    return F.concat_ws("\n", b, add_src, add_url)


def oneliner_finalize(text) -> Column:
    return truncate(py_strip(text), ONE_LINE_MAX)


def fallback_captions(title, source, url) -> dict[str, Column]:
    t = _v(title)
    return {
        "summary": truncate(t, FALLBACK_TITLE_MAX),
        "caption_telegram": F.concat(F.lit(TG_FALLBACK_PREFIX), t, F.lit(TG_FALLBACK_LINK), _v(url)),
        "caption_instagram": F.concat(F.lit(IG_FALLBACK_PREFIX), t, F.lit(IG_FALLBACK_SOURCE),
                                      _v(source)),
    }


def enrich(raw_items: DataFrame, generate: Generate, run_ts: Column | None = None,
           partitions: int | None = None, max_row_bytes: int = STORE_ROW_BYTES,
           answers: str | None = None, run: str = "") -> DataFrame:
    """Raw store rows -> patch rows (uid + patch fields).

    All-or-nothing fallback: if any call failed, all three texts are the
    fallback ones, ``ai_mode='fallback'`` and ``gemini_error`` is the first
    failure's message (unset when empty).  Fallback rows are 'ready' too.

    Status 'error' with ``processing_error`` and no texts: rows that come with a
    ``processing_error`` (see :func:`typed_rows`) or without a uid, which cost no
    call, and rows that their new texts make larger than ``max_row_bytes``.
    With ``answers``, a folder, answers are kept there and reused.
    """
    ts = (run_ts if run_ts is not None else F.current_timestamp()).cast("timestamp")
    j = call_model_once(raw_items, generate, answers, run, partitions) if answers else call_model(raw_items, generate, partitions)
    ok = F.col("model_error").isNull()
    fb = fallback_captions("title", "source", "url")
    made = j.select(
        "uid", "model_error", "processing_error", "row_bytes",
        F.when(ok, oneliner_finalize("text_one_line")).otherwise(fb["summary"]).alias("summary"),
        F.when(ok, telegram_finalize("text_telegram", "source", "url")).otherwise(fb["caption_telegram"]).alias("caption_telegram"),
        F.when(ok, F.col("text_instagram")).otherwise(fb["caption_instagram"]).alias("caption_instagram"))
    size = F.col("row_bytes") + text_bytes("summary", "caption_telegram", "caption_instagram")
    too_large = F.when(size > max_row_bytes, F.concat(
        F.lit("row of "), size.cast("string"), F.lit(f" bytes; the store takes {max_row_bytes}")))
    made = made.withColumn("processing_error", F.coalesce("processing_error", too_large))
    good = F.col("processing_error").isNull()
    return made.select(
        "uid", *(F.when(good, F.col(c)).alias(c) for c in ("summary", "caption_telegram", "caption_instagram")),
        F.when(good, "ready").otherwise("error").alias("status"),
        ts.alias("processed_at"),
        F.when(good, F.when(ok, "gemini").otherwise("fallback")).alias("ai_mode"),
        F.when(good & ~ok, F.nullif(F.col("model_error"), F.lit(""))).alias("gemini_error"),
        "processing_error")


def process_stats(store: DataFrame) -> DataFrame:
    """Run report: rows per (status, ai_mode); 'processed' = ready rows."""
    return store.groupBy("status", "ai_mode").agg(F.count(F.lit(1)).cast("long").alias("n"))
