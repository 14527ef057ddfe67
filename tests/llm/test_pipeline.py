"""The stages in order, each acting on what its predecessor kept."""

import corpus_pipeline as P

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, [docs.count()]
    for i, (name, step) in enumerate(P.STAGES):
        out = step(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if i < len(P.STAGES) - 1:
            assert after.columns == columns
            assert after.where("n_chars <> char_length(text)").count() == 0
            kept.append(after.count())
            docs = after
    assert kept[0] >= kept[1] > kept[2] == kept[3] == kept[4]
    assert docs.where(r"text rlike '[A-Za-z0-9._%+-]@[A-Za-z0-9-]+\\.'").count() == 0
    assert after.agg({"length": "max"}).first()[0] <= 2048
    assert after.select("doc_id").distinct().count() == kept[4]


def odd_rows():
    from test_operators import prose
    passage = " ".join(a + b + "ing" for a in "bcdfgh" for b in "aeiouylrst")
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, prose(1, 200)), (4, prose(1, 200)), (5, prose(1, 200).replace("alpha", "omega", 1)),
            (6, prose(2, 30) + "\n" + passage + "\n" + prose(3, 30)), (7, prose(4, 25) + " " + passage + " " + prose(5, 25)),
            (8, "write to ann@mail.example.org or 10.1.2.3, card 4111 1111 1111 1111"), (9, prose(6, 9000)), (10, "x" * 30_000),
            (11, prose(7, 50)), (11, prose(7, 50)), (None, prose(8, 50)), (None, prose(8, 50)), (12, "漢字 é ñ Straße")]
    for i in range(100, 340):
        bad = ["you", "vile", "scum", "you", "rotten", "filth"] * 2 if i % 2 else []
        rows.append((i, " ".join(prose(i, 40).split()[:20] + bad + prose(i + 1000, 30).split())))
    return rows


def test_each_stage_against_brute_force_on_odd_rows(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows: what every stage keeps and writes."""
    import public_tokenizers
    from newsflow.llm import pii, toxicity
    from test_mends import masked_plainly
    from test_operators import plain_cut, shingle_set
    from tokenizers import Tokenizer
    rows = odd_rows()
    docs = spark.createDataFrame([(i, t, "en", "s", len(t) if t else 0) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2, i % 2) for i in range(100, 340)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    step = dict(P.STAGES)

    def next_(name, df):
        out = step[name](spark, df, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    def pairs(df):
        return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    scored = {(r.doc_id, r.predicted) for r in toxicity.toxicity_report(docs, spark.read.parquet(f"{tmp_path}/labels.parquet")).collect()}
    one = next_("toxicity", docs)
    assert pairs(one) == sorted(((i, t) for i, t in rows if (i, 1) not in scored), key=str)
    assert sum(i is not None and i >= 100 and i % 2 == 1 for i, _ in pairs(one)) < 20 < 100 < sum(i is not None and i >= 100 for i, _ in pairs(one))

    two = next_("near_duplicates", one)
    left = sorted(set(pairs(one)), key=str)
    sets = [shingle_set(t, 5) for _, t in left]
    root = list(range(len(left)))

    def find(k):
        return k if root[k] == k else find(root[k])
    for a in range(len(left)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(left):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    assert pairs(two) == sorted(((i, t) for k, (i, t) in enumerate(left) if i is None or not sets[k] or least[find(k)] == i), key=str)

    three = next_("substring_dedup", two)
    before = pairs(two)
    assert pairs(three) == sorted(((i, t) for (i, _), (t, _) in zip(before, plain_cut(before, 20))), key=str)
    kept = dict(pairs(three))
    assert 6 not in kept or "baing being" in kept[6]
    assert not {6, 7} <= kept.keys() or "baing" not in kept[7]

    four = next_("pii", three)
    found = pii.find_pii(three).collect()
    want = sorted(((r.doc_id, None if r.text is None else masked_plainly(r.text, [(s.start, s.end, s.kind) for k in pii.PATTERNS for s in r[f"pii_{k}"]]))
                   for r in found), key=str)
    assert pairs(four) == want and (8 not in dict(want) or "[EMAIL]" in dict(want)[8] and "[CARD]" in dict(want)[8])
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in four.collect())

    five = next_("packing", four)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens = sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in pairs(four))
    assert five.agg({"length": "sum"}).first()[0] == tokens
    by_sequence = {}
    for r in five.collect():
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        places.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and places[0][0] == 0 and sum(places[-1]) <= 2048


def test_stages_of_nothing_and_with_further_columns(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, seen int, row string, cuts int"
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    some = [(1, "one text of a few words", "en", "s", 5, 1, "r", 2), (2, None, None, None, None, None, None, None)]
    for rows in ([], some):
        docs = spark.createDataFrame(rows, schema)
        for name, step in P.STAGES:
            out = step(spark, docs, str(tmp_path))
            assert out.count() == len(rows)
            if name != "packing":
                assert out.columns == P.COLUMNS
                docs = out
