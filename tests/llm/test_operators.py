"""Each operator against brute force on small tables: nulls, empty and long texts,
repeated rows, empty tables and further columns with clashing names."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from newsflow.llm import (boosting, langid, line_dedup, merge_dropout, packing, permutation_index, pii, quality,
                          superminhash, toxicity, winnowing)

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
VOCAB = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCAB) + rng.choice(["", "", "", ".", ","]) for _ in range(n))


ROWS = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "ONE"), (5, prose(1, 120)), (6, prose(1, 120)),
        (7, prose(1, 120).replace("alpha", "omega", 1)), (8, prose(2, 4000)), (9, "x" * 5000), (10, "é ñ ß 漢字 Straße"),
        (11, prose(3, 60)), (11, prose(3, 60)), (12, prose(4, 40) + "\n" + prose(1, 120)), (None, prose(5, 30))]
SCHEMA = "doc_id long, text string, root long, band string, class int, score double"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 9, "b", 1, 0.5) for i, t in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def shingle_set(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates_equal_all_pairs(docs, none, words):
    got = superminhash.near_duplicates(docs, words).collect()
    assert len(got) == len(ROWS)
    sets = [shingle_set(t, words) for _, t in ROWS]
    root = list(range(len(ROWS)))

    def find(i):
        return i if root[i] == i else find(root[i])
    for i in range(len(ROWS)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    for (doc, _), s, i in zip(ROWS, sets, range(len(ROWS))):
        ids = [d for k, (d, _) in enumerate(ROWS) if find(k) == find(i) and d is not None]
        rows = [r for r in got if r.doc_id == doc]
        assert {r.n_shingles for r in rows} == {len(s)}
        assert {r.component_id for r in rows} == {min(ids) if ids and s else doc}
        assert all(r.kept == (doc is None or r.component_id == doc) for r in rows)
    assert superminhash.near_duplicates(none).collect() == []


def test_near_duplicates_of_a_chain_of_copies(spark):
    """Copies that drift: links between neighbours only, so no hub sees them all."""
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join(words)))
        words = words[:-4] + [f"x{i}{j}" for j in range(4)] if i % 2 else [f"y{i}{j}" for j in range(4)] + words[4:]
    got = superminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    sets = [shingle_set(t, 2) for _, t in rows]
    best = list(range(40))
    for _ in range(40):
        for i in range(40):
            for j in range(40):
                if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    best[i] = min(best[i], best[j])
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(best))


def test_near_duplicates_lose_no_link_of_null_ids(spark):
    """A null id in a class of equal sets, and one that alone joins two texts."""
    words = [f"w{i}" for i in range(300)]
    near = words[:-6] + ["n1", "n2", "n3", "n4", "n5", "n6"]
    chain = [[f"c{i}" for i in range(300)]]
    for k in range(2):
        chain.append(chain[-1][25:] + [f"d{k}{j}" for j in range(25)])
    rows = [(None, words), (7, words), (5, near), (None, words), (21, chain[0]), (None, chain[1]), (20, chain[2]), (None, ["alone"])]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.component_id) for r in superminhash.near_duplicates(df, 2).collect()), key=str)
    assert got == sorted([(None, 5), (7, 5), (5, 5), (None, 5), (21, 20), (None, 20), (20, 20), (None, None)], key=str)


@pytest.mark.parametrize("n", [100, 400])
def test_unlinked_boilerplate_is_neither_paired_nor_dealt(spark, n):
    """Texts that share two thirds of their words fall into common buckets, yet cost in proportion."""
    shared = " ".join(f"b{i}" for i in range(130))
    df = spark.createDataFrame([(i, shared + " " + " ".join(f"u{i}x{j}" for j in range(70))) for i in range(n)], "doc_id long, text string")
    sets = [superminhash.shingles(r.text, 2, superminhash.WordHashes()) for r in df.collect()]
    members = spark.createDataFrame([(i, i, len(s), bytearray(s.tobytes())) for i, s in enumerate(sets)],
                                    "row long, root long, n long, set binary")
    posts = superminhash.front_posts(members, 80)
    assert posts.count() <= 0.21 * sum(map(len, sets)) + n
    assert posts.groupBy("shingle").count().where("count > 1").count() == 0
    assert all(r.kept for r in superminhash.near_duplicates(df, 2).collect())


def test_signature_equals_the_sequential_algorithm():
    rng = np.random.default_rng(3)
    m = 64
    for n in (1, 3, 40, 500):
        s = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
        rank = [2 ** 64 - 1] * m
        for d in s:
            p = list(range(m))
            for j in range(m):
                draw = int(superminhash.mix64(np.array([(int(d) + (j + 1) * int(superminhash.GOLDEN)) % 2 ** 64], np.uint64))[0])
                k = j + ((draw >> 32) * (m - j) >> 32)
                p[j], p[k] = p[k], p[j]
                rank[p[j]] = min(rank[p[j]], j << 32 | draw & 0xFFFFFFFF)
        assert superminhash.signatures([s], m)[0].tolist() == rank


def test_keep_one_keeps_columns(docs, none):
    kept = superminhash.keep_one(docs, 2)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=lambda i: (i is None, i)) == [0, 1, 2, 3, 5, 8, 9, 10, 11, 12, None]
    assert superminhash.keep_one(none).collect() == []


def test_packing_covers_every_id_once(docs, none):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(WORD_BPE)
    got = packing.pack(docs, WORD_BPE, with_ids=True).collect()
    for doc, text in ROWS:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        pieces = sorted((r for r in got if r.doc_id == doc), key=lambda r: r.start)
        copies = sum(d == doc for d, _ in ROWS)
        assert sum(r.length for r in pieces) == copies * len(ids)
        assert all(r.ids == ids[r.start:r.start + r.length] and r.doc_tokens == len(ids) for r in pieces)
        assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in pieces)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length, r["class"]))
    for held in bins.values():
        held.sort()
        assert [o for o, _, _ in held] == [sum(n for _, n, _ in held[:i]) for i in range(len(held))]
        assert sum(n for _, n, _ in held) <= 2048 and len(held) <= held[0][2]
    open_bins = {}
    for held in bins.values():
        open_bins[held[0][2]] = open_bins.get(held[0][2], 0) + (len(held) < held[0][2])
    assert max(open_bins.values()) <= 1
    assert packing.pack(none, WORD_BPE).collect() == []


@pytest.mark.parametrize("text", ["Don't STOP 12³ “quoted” naïve_word İstanbul ſ K", "á é <|endoftext|> x\x85y\xa0z\x1cq",
                                  "\x00\x1f tab\tÀÉ it's we'll 'start", "Σίσυφος ΣΑΣ"])
def test_remembered_pre_tokens_give_the_tokenizers_ids(text):
    from tokenizers import Tokenizer
    assert list(packing.WordTokenizer(WORD_BPE).encode(text)) == Tokenizer.from_file(WORD_BPE).encode(text, add_special_tokens=False).ids


def test_cut_lengths_bound_padding():
    for n in range(1, 7000):
        cut = packing.cut_lengths(n)
        assert sum(cut) == n and all((2048 // c) * c >= 0.95 * 2048 for c in cut)


def plain_cut(rows, size):
    """(left text, removed spans) of every row by comparing word runs and lines as such."""
    def runs(text):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        words, out, at = re.findall(r"[^\x20\x09-\x0D]+", low), [], 0
        out += [(("gram", *words[i:i + size]), i, i + size) for i in range(len(words) - size + 1)]
        for line in low.split("\n"):
            n = len(re.findall(r"[^\x20\x09-\x0D]+", line))
            if n:
                out.append((("line", *words[at:at + n]), at, at + n))
            at += n
        return out
    held = [(i, t, runs(t)) for i, t in rows if i is not None and t]
    for doc, text in rows:
        if doc is None or not text:
            yield text, []
            continue
        earlier = {r for i, _, rs in held if i < doc for r, _, _ in rs}
        first, gone = {}, set()
        for r, a, b in runs(text):
            if r in earlier or first.setdefault(r, b) <= a:
                gone.update(range(a, b))
        place = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
        cut, i = [], 0
        while i < len(place):
            j = i
            while j < len(place) and j in gone:
                j += 1
            if j > i:
                (start, _), (_, end) = place[i], place[j - 1]
                after = place[j][0] if j < len(place) else len(text)
                if "\n" not in text[end:after]:
                    end = after
                elif start == 0 or text[start - 1] == "\n":
                    end = text.index("\n", end) + 1
                cut.append((start, end))
            i = j + 1
        yield "".join(c for k, c in enumerate(text) if not any(a <= k < b for a, b in cut)), cut


def mosaic(seed, n):
    """Texts pasted together from a few passages, lines and runs of one word."""
    rng = random.Random(seed)
    stock = [prose(100 + i, rng.randrange(3, 40)) for i in range(8)] + ["again " * 30, "one line\n", "\n\n"]
    return [(rng.randrange(n), rng.choice(["", " ", "\n"]).join(rng.choice(stock) + " " + prose(rng.randrange(10 ** 6), rng.randrange(4))
                                                               for _ in range(rng.randrange(6)))) for _ in range(n)]


@pytest.mark.parametrize("rows", [ROWS, mosaic(1, 40), mosaic(2, 60)], ids=["odd", "mosaic1", "mosaic2"])
def test_line_dedup_against_one_pass(spark, rows):
    names = "doc_id long, text string, seen array<long>, removed string, _doc int, id int, tkey long, row string, cuts int, n_chars int"
    df = spark.createDataFrame([(i, t, [1], "x", 7, 8, 9, "r", 4, -1) for i, t in rows], names).repartition(3)
    out = line_dedup.dedup_units(df, min_words=10)
    assert out.columns == [c for c in df.columns if c != "removed"] + ["removed"]
    got = sorted(out.collect(), key=lambda r: str((r.doc_id, r.text, r.removed)))
    want = sorted(((i, t, cut) for (i, _), (t, cut) in zip(rows, plain_cut(rows, 10))), key=lambda r: str((r[0], r[1], [tuple(x) for x in r[2]])))
    assert sorted((str(r.doc_id), r.text or "", [tuple(s) for s in r.removed]) for r in got) == sorted((str(i), t or "", cut) for i, t, cut in want)
    assert all((r.seen, r._doc, r.id, r.tkey, r.row, r.cuts) == ([1], 7, 8, 9, "r", 4) for r in got)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)


def test_line_dedup_of_nothing(none):
    assert line_dedup.dedup_units(none).collect() == []


def test_inline_passage_goes_from_the_later_document(spark):
    passage = " ".join(f"token{i}" + ("." if i % 9 == 8 else "") for i in range(70))
    rows = [(1, "Before it " + passage + " after it"), (2, "Other words and " + passage + " then more"), (3, "Nothing shared here at all")]
    got = {r.doc_id: r for r in line_dedup.dedup_units(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].text == rows[0][1] and got[3].text == rows[2][1]
    assert len(got[2].text.split()) < 7 + 25 and got[2].text.startswith("Other words and")


def test_pasted_passages_go_to_the_word(spark):
    rows = []
    for n in (19, 20, 30, 51):
        passage = " ".join(f"w{n}x{i}" for i in range(n))  # no sentence marks
        rows += [(n, f"Before{n} it{n} {passage} after{n}"), (100 + n, f"Other{n} words{n} {passage} then{n} more{n}")]
    got = {r.doc_id: r.text for r in line_dedup.dedup_units(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[d] == t for d, t in rows if d < 100 or d == 119)
    assert all(got[100 + n] == f"Other{n} words{n} then{n} more{n}" for n in (20, 30, 51))


def test_short_repeated_lines_go(spark):
    rows = [(i, f"own{i} first{i} line\nSubscribe to our  daily letter today\nown{i} last{i} line") for i in range(4)]
    rows += [(9, "in a line subscribe to our daily letter today it stays")]
    got = {r.doc_id: r.text for r in line_dedup.dedup_units(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == rows[0][1] and got[9] == rows[4][1]
    assert all(got[i] == f"own{i} first{i} line\nown{i} last{i} line" for i in (1, 2, 3))


PII_ROWS = [(1, "mail a.b@c.d.e%f@g.hi now, 10.0.0.256 and 1.2.3.4.5 or 010.1.1.1"), (2, "card 4111 1111 1111 1111 vs 4111 1111 1111 1112"),
            (3, "call +1 (017) 555-7713 or +12 3"), (4, "IBAN GB82 WEST 1234 5698 7654 32 end, 漢字 +49 123 456 7890 1"),
            (5, None), (6, ""), (7, "a" * 20000 + "@"), (8, "9" * 20000), (9, "x@" + "a." * 5000), (10, "my account 123456789 but 987654321 alone")]


def test_pii_against_python(spark, none):
    pats = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def good(kind, s):
        d = re.sub("[^0-9]", "", s)
        if kind == "ip":
            return all(int(p) <= 255 for p in s.split("."))
        if kind == "card":
            luhn = sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(d[::-1]))
            return 13 <= len(d) <= 19 and luhn % 10 == 0
        return kind != "phone" or 9 <= len(d) <= 15
    rows = [r for r in PII_ROWS if r[0] != 7]
    frame = spark.createDataFrame([(i, t, "k") for i, t in PII_ROWS], "doc_id long, text string, kind string")
    got = {r.doc_id: r for r in pii.pii_report(frame).collect()}
    for i, text in rows:
        spans = [f"{k}:{m.start()}:{m.end()}" for k in pats for m in re.finditer(pats[k], text or "") if good(k, m[0])]
        assert got[i].base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest(), (i, got[i].spans, spans)
    assert "iban:5:32" in got[4].spans and "account:11:20" in got[10].spans and "account:25" not in got[10].spans
    masked = {r.doc_id: r.text for r in pii.mask_pii(frame).collect()}
    assert masked[2] == "card [CARD] vs 4111 1111 1111 1112" and masked[5] is None
    assert pii.pii_report(none).collect() == [] and pii.mask_pii(none).collect() == []


def vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in v], "z") for i, v in enumerate(rng.normal(size=(600, 16)))]
    rows += [(1000 + i, rows[5][1], "z") for i in range(60)]  # one common vector
    rows += [(2000, None, "z"), (2020, [0.0] * 16, "z"), (2040, [float("nan")] * 16, "z"), (2060, [1.0, 2.0], "z"), (None, rows[1][1], "z"), rows[7]]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>, vkey string")


def test_permutation_index_recall(spark):
    rows, frame = vectors(spark)
    got = {}
    for r in permutation_index.nearest(frame, frame.where("vec_id % 20 = 0"), 20).collect():
        got.setdefault(r.query_id, []).append(r)
    ok = {i: np.array(v) for i, v, _ in rows if i is not None and i < 2000}
    hits = 0
    assert set(got) == {i for i in ok if i % 20 == 0}
    for q, found in got.items():
        found.sort(key=lambda r: r["rank"])
        exact = sorted(((-float(ok[q] @ v), i) for i, v in ok.items() if i != q))[:20]
        assert [r["rank"] for r in found] == list(range(1, 21))
        assert [(r.score, -r.vec_id) for r in found] == sorted([(r.score, -r.vec_id) for r in found], reverse=True)
        assert all(abs(r.score - ok[q] @ ok[r.vec_id]) < 1e-9 for r in found)
        hits += len({r.vec_id for r in found} & {i for _, i in exact})
    assert hits / (20 * len(got)) >= 0.9
    few = frame.where("vec_id in (0, 20, 33)")
    assert permutation_index.nearest(few, few.where("vec_id % 20 = 0"), 20).count() == 4
    assert permutation_index.nearest(frame.limit(0), frame.limit(0), 20).collect() == []


def test_merge_dropout_is_lossless_and_seeded(docs, none):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    model = merge_dropout.MergeModel(PIECE_BPE)
    plain, dropped = merge_dropout.Encoder(model, 0.0), merge_dropout.Encoder(model, 0.2, seed=5)
    held = [t for _, t in ROWS if t] + ["  a  b\n c\t", "é　x ﬁ " + "abc" * 40, "日本語" * 30, "a.b,,c ;d"]
    assert [ids.tolist() for ids in plain.encode_all(held, [0] * len(held))] == sp.encode(held)
    for i, t in enumerate([*held, "a▁b", "▁"]):
        assert dropped.decode(dropped.encode(t, i)) == t
        assert dropped.encode(t, i).tolist() == merge_dropout.Encoder(model, 0.2, seed=5).encode(t, i).tolist()
    text = prose(9, 400)
    assert len({tuple(merge_dropout.Encoder(model, 0.2, seed=s).encode(text).tolist()) for s in range(4)}) == 4
    # short segments merged together and long ones by a heap agree
    word = "internationalisations"
    key = dropped._keys([(0, word)])
    assert dropped._together([word], len(word), key)[0] == dropped._by_heap(word, key)
    ids = merge_dropout.encode(docs, PIECE_BPE, 0.2, 5)
    back = {(r.doc_id, r.text) for r in merge_dropout.decode(ids, PIECE_BPE).collect()}
    assert back == {(d, t or "") for d, t in ROWS}
    assert all(r.lossless for r in merge_dropout.round_trip(docs, PIECE_BPE).collect())
    assert merge_dropout.round_trip(none, PIECE_BPE).collect() == []


def test_merge_dropout_varies_every_occurrence():
    model = merge_dropout.MergeModel(PIECE_BPE)
    e = merge_dropout.Encoder(model, 0.1, seed=3)
    word, n = "internationalisations", 400
    one = e.encode_all([" ".join([word] * n)], [7])[0].tolist()
    cuts, cut = [], []
    for i in one:  # the cut of each occurrence
        cut.append(i)
        if b"".join(model.bytes_of[j] for j in cut).strip() == word.encode():
            cuts.append(tuple(cut))
            cut = []
    assert len(cuts) == n and len(set(cuts)) > 2
    # the remembered cuts give what merging each occurrence by its own hashes gives
    for text, doc in ((" ".join([word, "reading", "of", "Straße", "x" * 60] * 50), 4), (prose(6, 300), 5)):
        segments = model.segment.findall(" " + text)
        keys = merge_dropout.mix64(e._keys([(doc, text)]) + np.arange(len(segments), dtype=np.uint64) * merge_dropout.A)
        expected = b"".join(e._by_heap(s, keys[i:i + 1]) for i, s in enumerate(segments))
        assert e.encode(text, doc).tobytes() == expected
    # documents differ, too
    assert len({tuple(e.encode(word, d).tolist()) for d in range(200)}) > 2


def test_winnowing_choice_and_guarantee():
    w = winnowing.Winnower(5, 4)
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 9, 300):
        h = rng.integers(0, 5, n).astype(np.uint64)
        expected = set()
        for s in range(max(1, n - 3) if n else 0):
            part = h[s:s + 4].tolist()
            expected.add(s + max(i for i, v in enumerate(part) if v == min(part)))
        assert w.choose(h)[1].tolist() == sorted(expected)
    shared = prose(4, 30)[:8]  # k + window - 1 code points
    a, b = w.fingerprint("zzzqq" + shared + "12"), w.fingerprint(shared + "ßßß")
    assert set(a[0].tolist()) & set(b[0].tolist())


def test_winnowing_compares_neighbours(docs, none):
    got = winnowing.compare_with_next(docs).collect()
    by_id = {r.doc_id: r for r in got}
    order = sorted({(d, t or "") for d, t in ROWS if d is not None}, reverse=True) + [(None, ROWS[-1][1])]
    for (doc, text), (_, after) in zip(order, order[1:] + order[:1]):
        if doc == 11:
            after = text if by_id[doc].near_next == 1.0 else after  # one of the two repeated rows
        n = len(text) // 3
        edited = {hashlib.sha256((text[:len(text) - n] + x[:n]).encode()).hexdigest() for x in (after, text)}
        assert by_id[doc].edited_sha256 in edited and by_id[doc].n_chars == len(text)
    assert by_id[5].fingerprint == by_id[6].fingerprint and len(got) == len(ROWS)
    assert by_id[0].fingerprint == "" and by_id[3].fingerprint.endswith(":0")
    assert winnowing.compare_with_next(none).collect() == []
    assert winnowing.fingerprints(none).collect() == []


def test_short_edited_texts_score_above_their_neighbour(spark):
    rng = random.Random(8)
    rows = [(i, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n)))
            for i, n in enumerate([*range(22, 64, 3), *range(64, 200, 9)])]
    for r in winnowing.compare_with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert r.near_edited > 0 and r.near_edited > r.near_next, r


def test_language_mixtures(spark, none):
    english = [prose(i, 60) for i in range(40)]
    other = [" ".join(random.Random(i).choices("straße über fröhlich größe müssen können weiß heißt".split(), k=60)) for i in range(40)]
    rows = [(i, t, "en", "s") for i, t in enumerate(english)] + [(100 + i, t, "de", "s") for i, t in enumerate(other)]
    rows += [(900, None, "en", "s"), (901, "123 !!", "de", "s"), (902, english[0] + " " + other[0], None, "s"), (903, "x", None, "s")]
    got = {r.doc_id: r for r in langid.language_report(spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")).collect()}
    assert all(got[i].lang_pred == "en" and got[100 + i].lang_pred == "de" for i in range(40))
    assert got[900].lang_pred == got[901].lang_pred == "und" and got[902].n_languages == 2
    assert got[903].lang_pred in ("en", "de") and all(0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got.values())
    assert langid.language_report(none.withColumn("lang", F.lit(None).cast("string"))).collect() == []


def auc(score, y):
    order = np.argsort(np.argsort(score))
    return (order[y == 1].mean() - (y.sum() - 1) / 2) / (len(y) - y.sum())


def test_boosted_models_and_calibration():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(800, 4))
    y = (x[:, 0] * x[:, 1] + 0.5 * x[:, 2] > 0).astype(float)
    fresh = rng.normal(size=(400, 4))
    truth = (fresh[:, 0] * fresh[:, 1] + 0.5 * fresh[:, 2] > 0).astype(float)
    gam = boosting.fit_gam(x, y)
    assert (0, 1) in gam.pairs and auc(gam.raw(fresh), truth) > 0.9
    assert auc(boosting.fit_gbt(x, y).raw(fresh), truth) > 0.9
    knots, values = boosting.fit_isotonic(x[:, 2], y)
    assert (np.diff(values) >= 0).all() and (np.diff(knots) >= 0).all()


@pytest.mark.parametrize("module,target,report", [(quality, "quality", "quality_report"), (toxicity, "toxic", "toxicity_report")])
def test_classifiers_on_the_given_tables(spark, docs, none, module, target, report):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = getattr(module, report)(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id").toPandas()
    out = got[got.held_out]
    assert auc(out["score"].to_numpy(), out[target].to_numpy(float)) > (0.9 if target == "quality" else 0.7)
    blank = labels.where("false")
    assert {r.score for r in getattr(module, report)(docs, blank).collect()} == {0.5}
    assert getattr(module, report)(none, labels).collect() == []


def test_masked_words_are_found():
    codes = toxicity.Codes(toxicity.Lexicon(frozenset({"idiot"}), frozenset()))
    names = dict(zip(toxicity.NAMES, toxicity.features("you 1d10t and i d i o t", codes)))
    assert names["hidden_hits"] == 2 and names["near_you"] >= 1
