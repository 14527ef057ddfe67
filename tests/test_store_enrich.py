import pandas as pd
from pyspark.sql import functions as F

from conftest import SF
from newsflow.operators import enrich as E
from newsflow.operators import items as I
from newsflow.operators import store as S
from newsflow.plans import bindings as B
from newsflow.plans.queries import REGISTRY


def test_dedup_keeps_newest(spark):
    df = spark.createDataFrame(
        [("u1", 1, "2025-01-01 00:00:00"), ("u1", 2, "2025-02-01 00:00:00"), ("u1", 3, ""),
         ("u2", 4, ""), ("u2", 5, "")], "uid string, doc_id long, published string")
    out = I.dedup_uid(I.with_published(df), "doc_id").orderBy("uid").collect()
    assert [(r.uid, r.doc_id) for r in out] == [("u1", 2), ("u2", 4)]


def test_insert_is_idempotent(spark, tmp_path):
    root = str(tmp_path / "store")
    batch = I.dedup_uid(B.doc_items(spark, SF), "doc_id")
    n = batch.count()
    for expected in (n, 0):
        store = S.read_store(spark, root)
        new = S.insert_new(batch, store)
        assert new.count() == expected
        S.append_store(spark, root, S.store_row(new, B.run_ts()))
    assert S.read_store(spark, root).count() == n


def test_insert_never_changes_existing(spark):
    store = B.existing_store(spark, SF)
    out = REGISTRY["store_insert"](spark, SF)
    before = {r.uid: r.status for r in store.collect()}
    after = {r.uid: r.status for r in out.collect() if r.uid in before}
    assert before == after


def _items(spark):
    return spark.createDataFrame(
        [("a", "T1", "S1", "src", "https://u/1"), ("b", "T2", "", "src", "https://u/2"),
         ("c", "T3", "S3", "", "")],
        "uid string, title string, raw_summary string, source string, url string")


def _gen(fail_kind=None, bad=None, empty=None):
    def g(req: pd.DataFrame) -> pd.DataFrame:
        texts, errs = [], []
        for uid, kind in zip(req["uid"], req["kind"]):
            if kind == fail_kind:
                texts.append(None)
                errs.append(f"boom {kind}")
            elif bad and uid == bad:
                texts.append(3)
                errs.append(None)
            elif empty and kind == empty[0]:
                texts.append(empty[1])
                errs.append(None)
            else:
                texts.append(f" {kind}:{uid} ")
                errs.append(None)
        return pd.DataFrame({"text": pd.Series(texts, dtype=object), "error": errs})
    return g


def test_all_or_nothing_fallback(spark):
    for kind in E.KINDS:
        out = {r.uid: r for r in E.enrich(_items(spark), _gen(fail_kind=kind), B.run_ts()).collect()}
        a = out["a"]
        assert a.ai_mode == "fallback" and a.status == "ready"
        assert a.gemini_error == f"boom {kind}"
        assert a.summary == "T1"
        assert a.caption_telegram == "📰 T1\n\n🔗 https://u/1"
        assert a.caption_instagram == "🎬 T1\n\nSource: src"


def test_success_and_finalisers(spark):
    out = {r.uid: r for r in E.enrich(_items(spark), _gen(), B.run_ts()).collect()}
    a = out["a"]
    assert a.ai_mode == "gemini" and a.gemini_error is None
    assert a.summary == "one_line:a"
    assert a.caption_telegram == "telegram:a\nসূত্র: src\nhttps://u/1"
    assert a.caption_instagram == "instagram:a"
    assert out["c"].caption_telegram == "telegram:c"


def test_empty_answer_and_non_text_are_failures(spark):
    out = {r.uid: r for r in E.enrich(_items(spark), _gen(empty=("telegram", "")),
                                      B.run_ts()).collect()}
    assert out["a"].ai_mode == "fallback"  # an empty answer is a failure
    assert out["a"].gemini_error == "Empty model response"
    out = {r.uid: r for r in E.enrich(_items(spark), _gen(empty=("telegram", "   ")),
                                      B.run_ts()).collect()}
    assert out["a"].ai_mode == "gemini"  # whitespace-only is an answer; it strips to ''
    assert out["a"].caption_telegram == "\nসূত্র: src\nhttps://u/1"
    out = {r.uid: r for r in E.enrich(_items(spark), _gen(bad="b"), B.run_ts()).collect()}
    assert out["b"].status == "ready" and out["b"].ai_mode == "fallback"
    assert "text" in out["b"].gemini_error and out["b"].processing_error is None
    assert out["a"].status == "ready"


def test_patch_keeps_other_fields(spark):
    store = B.existing_store(spark, SF)
    raw = store.where(F.col("status") == "raw")
    patch = E.enrich(raw, _gen(), B.run_ts())
    out = S.apply_patch(store, patch)
    assert out.count() == store.count()
    assert out.where(F.col("status") == "raw").count() == 0
    j = out.join(store.select("uid", F.col("title").alias("t0")), "uid")
    assert j.where(F.col("title") != F.col("t0")).count() == 0


def test_hot_uid_third_of_rows(spark):
    """A uid holding a third of all rows (empty link and title) dedups to one
    row: the newest, smallest key on ties."""
    from pyspark.sql import functions as F
    n = 3000
    df = spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), F.col("id")))
        .alias("uid"),
        F.when(F.col("id") == 2997, F.lit("2025-06-01 00:00:00"))
        .otherwise(F.lit("2025-01-01 00:00:00")).alias("published"))
    out = I.dedup_uid(I.with_published(df).repartition(8), "doc_id")
    assert out.count() == 1 + 2 * n // 3
    assert out.where(F.col("uid") == "hot").first().doc_id == 2997


def test_landed_rows_of_the_wrong_type_get_an_error_patch(spark, tmp_path):
    """A failure outside the model stays with its row, costs no call and names its cause."""
    docs = {"a": '{"title": "T", "raw_summary": "S", "url": "u", "source": null}', "b": '{"title": 7, "url": ["x"]}', "c": "[1]", "d": "no json",
            "e": '{"title": "T", "media_url": {"x": 1}}', "f": None, "g": "{}", "": '{"title": "T"}'}
    landed = spark.createDataFrame(list(docs.items()) + [(None, '{"title": "T"}')], "uid string, document string")
    asked = spark.sparkContext.accumulator(0)

    model = _gen()

    def generate(req):
        asked.add(len(req))
        assert set(req["uid"]) <= {"a", "g"}
        return model(req)

    for answers in (None, str(tmp_path / "answers")):
        out = {r.uid: r for r in E.enrich(E.typed_rows(landed), generate, B.run_ts(), answers=answers).collect()}
        assert {u: r.processing_error for u, r in out.items()} == {
            "a": None, "b": "title must be text, got bigint", "c": "document must be a JSON object", "d": "document must be a JSON object",
            "e": "media_url must be text, got object", "f": "document must be a JSON object", "g": None, "": "uid is missing", None: "uid is missing"}
        for u, r in out.items():
            good = r.processing_error is None
            assert r.status == ("ready" if good else "error") and (r.summary is not None) == good and (r.ai_mode is not None) == good
    assert asked.value == 2 * 2 * 3


def test_a_row_the_store_does_not_take_gets_an_error_patch(spark, tmp_path):
    items = _items(spark)
    small = {r.uid: r for r in E.enrich(items, _gen(), B.run_ts(), max_row_bytes=60).collect()}
    assert small["a"].status == "error" and small["a"].summary is None and small["a"].ai_mode is None
    assert small["a"].processing_error.endswith("bytes; the store takes 60")
    assert small["c"].status == "ready"
    store = S.store_row(items.withColumnsRenamed({"raw_summary": "summary_raw", "url": "link"}).selectExpr(
        "*", "'' feed_url", "'' full_text", "'' media_url", "'' published", "'' published_dt_str"), B.run_ts())
    out = {r.uid: r for r in S.apply_patch(store, E.enrich(store, _gen(), B.run_ts(), max_row_bytes=60)).collect()}
    assert out["a"].status == "error" and out["a"].title == "T1" and out["c"].status == "ready"


def test_answers_are_reused_and_failures_too(spark, tmp_path):
    answers = str(tmp_path / "answers")
    plain = sorted(map(tuple, E.enrich(_items(spark), _gen(fail_kind="telegram"), B.run_ts()).collect()))
    first = E.enrich(_items(spark), _gen(fail_kind="telegram"), B.run_ts(), answers=answers, run="1")
    assert sorted(map(tuple, first.collect())) == plain

    def never(req):
        raise RuntimeError("asked again")
    again = E.enrich(_items(spark), never, B.run_ts(), answers=answers, run="2")
    assert sorted(map(tuple, again.collect())) == plain
    changed = _items(spark).withColumn("title", F.when(F.col("uid") == "b", "new").otherwise(F.col("title")))
    got = {r.uid: r for r in E.enrich(changed, never, B.run_ts(), answers=answers, run="3").collect()}
    assert got["b"].gemini_error == "asked again" and got["a"].gemini_error == "boom telegram"  # another prompt is another request
