"""Every operator against its plain version, on the smallest tables and on awkward rows."""

import os
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from brute import base_rules, cluster, components, contamination, crc, line_dedup, sha, unigram
from brute_models import languages as plain_languages
from brute_models import quality_scores
from brute_trie import nodes as trie_nodes
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

import corpus_pipeline
from cairn.llm import (
    byte_pairs, centroids, decontamination, jaccard_join, languages, lm_scoring, piece_agenda, prefix_trie, queries, quality_classifier, quality_rules, sharding,
)
from cairn.llm import line_dedup as dedup
from cairn.llm.components import connect

SF_DIR = os.environ.get("CAIRN_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = StructType(
    [StructField("doc_id", LongType()), *(StructField(c, StringType()) for c in ("text", "lang", "source")), StructField("n_chars", LongType())]
    # names that the operators use inside
    + [StructField(c, StringType()) for c in ("row", "class", "draw", "lines", "ident", "score", "pack")]
)


def awkward():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 12))) for _ in range(60)]
    words = [rng.choice(vocabulary) for _ in range(400)]
    base = " ".join(words[:120])
    near = " ".join([*words[:60], "zzz", *words[61:120]])
    line = "The same long line stands here."
    texts = [
        None, "", " \n\t ", "one", "One  TWO three", "a b c d e", "a b c d e f", base, base, base.upper(), near, base + " end",
        f"{line}\nfirst\n  {line.upper()}\t\nshort", f"other\r\n{line}", f"{line}\n{line}", "\n\n", "ÉCOLE " * 30, "école " * 30,
        "x" * 30_000, "<|endoftext|> it's  <|endoftext|>", "日本語 と русский text " * 8, "a\x1cb c d",
        " ".join(rng.choice(vocabulary) for _ in range(9000)), "### $$$ |||\n" * 9,
    ]
    rows = [(i, t, ["en", "de", None][i % 3], ["s", None][i % 2], 1) for i, t in enumerate(texts)]
    rows += [(50 + i, f"{base} {i % 4} tail {vocabulary[i]}", "en", "hot", 1) for i in range(12)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return awkward()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 7) for r in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def odd(spark, rows):
    """Repeated rows and null ids besides."""
    more = [*rows, rows[7], rows[7], (None, rows[7][1], None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame([(*r, *[None] * 7) for r in more], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_sharding_cuts_evenly(spark, docs, odd, empty):
    for df in (docs, odd, table(spark, "documents")):
        out = sharding.shard_documents(df, shards=5).collect()
        assert len(out) == df.count()
        sizes = np.bincount([r["shard"] for r in out], minlength=5)
        assert sizes.max() - sizes.min() <= 1
        for shard in range(5):
            assert sorted(r["slot"] for r in out if r["shard"] == shard) == list(range(sizes[shard]))
        for r in out:
            assert 0 <= r["text_crc32"] < 2**32 and r["size"] >= 8 and r["law"] == "rows"
    assert sharding.shard_documents(empty).collect() == []


def test_sharding_keeps_the_mixture(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 20)).alias("source"))
    out = sharding.shard_documents(docs, shards=10).groupBy("shard").agg(F.sum((F.col("source") == "hot").cast("int")).alias("hot")).collect()
    assert all(abs(r["hot"] - 100) <= 3 for r in out)


def test_sharding_splits_rows_that_share_an_id_or_everything(spark):
    ids = F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.lit(None)).cast("long").alias("doc_id")
    text = F.when(F.col("id") % 2 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("text")
    docs = spark.range(30_000).select(ids, text, F.lit("s").alias("source"), F.lit(1).alias("n"), F.lit(2).alias("first"))
    out = sharding.shard_documents(docs, shards=7)
    found = out.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("slots"), F.max("slot").alias("top")).collect()
    assert len(found) == 7 and all(r["n"] == r["slots"] == r["top"] + 1 and abs(r["n"] - 30_000 / 7) < 1 for r in found)
    want = Counter(map(tuple, docs.select("doc_id", F.crc32(F.col("text").cast("binary"))).collect()))
    assert Counter((r["doc_id"], r["text_crc32"]) for r in out.collect()) == want
    # rows of one id are dealt over many ranges
    identity = F.concat_ws("|", F.lit("7"), F.crc32(F.col("text").cast("binary")), F.octet_length("text") + 8)
    assert docs.where("doc_id = 7").select(F.shiftright(sharding.draw(1, identity), 50)).distinct().count() > 900


def check_scores(out, rows):
    for doc, held, n, known, total, base in unigram(pairs(rows)):
        r = out[doc]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert np.isfinite(r["score"]) and r["score"] <= 0


def test_lm_scoring(spark, docs, odd, empty, rows):
    check_scores(by_id(lm_scoring.score_documents(docs)), rows)
    assert lm_scoring.score_documents(odd).count() == odd.count()
    assert lm_scoring.score_documents(empty).collect() == []


def test_lm_scoring_on_the_tables(spark):
    documents = table(spark, "documents")
    out = by_id(queries.op2_lm_scoring(spark, SF_DIR))
    check_scores(out, [(r["doc_id"], r["text"]) for r in documents.collect()])


def text_docs(spark, texts, schema="doc_id long, text string"):
    return spark.createDataFrame(texts, schema)


def test_lm_scores_do_not_depend_on_the_chunks(spark, monkeypatch):
    words = [f"{'abcdefgh'[k % 8] * (k % 5 + 1)}{k}{'ization' * (k % 4)}" for k in range(300)]
    rows = [(i, " ".join(words[(i * 7 + j * j) % 300] for j in range(60)) + (f" only{i} onlyonlyonlyonly{i}" if i % 3 else "")) for i in range(80)]
    docs = text_docs(spark, [*rows, (200, None), (201, "")]).coalesce(1)
    whole = by_id(lm_scoring.score_documents(docs))
    monkeypatch.setattr(lm_scoring, "CHUNK", 700)
    staged = lm_scoring.staged_texts(docs)
    assert staged.select("chunk").distinct().count() > 40
    cut = by_id(lm_scoring.score_documents(docs))
    assert sum(r["held_out"] for r in whole.values()) > 3 and set(whole) == set(cut)
    for doc, r in whole.items():
        # spellings are counted by piece of a chunk, so its bounds shift the chances of new words a little
        assert cut[doc]["score"] == pytest.approx(r["score"], rel=1e-2 if r["n_known"] == r["n_tokens"] else 5e-2)
        assert (cut[doc]["n_known"], cut[doc]["base_score"]) == (r["n_known"], pytest.approx(r["base_score"]))


def lm_texts(*texts):
    data = [t.encode() for t in texts]
    return lm_scoring.Texts(np.frombuffer(b"".join(data), np.uint8), np.append(0, np.cumsum([len(d) for d in data])))


def test_lm_units(spark):
    cut = lm_scoring.units(lm_texts("One  two", "", "x" * 40 + " a", "x" * 40))
    assert cut.token_bounds.tolist() == [0, 3, 4, 7, 9] and cut.bounds.tolist() == [0, 3, 4, 9, 13]
    assert cut.spans.length.tolist() == [3, 3, 16, 16, 8, 1, 16, 16, 8] and cut.last.tolist() == [True, True, False, False, True, True, False, False, True]
    # of the three pieces the two equal ones are one unit, the last is another; a word that is as long as a piece is neither
    assert cut.keys[4] == cut.keys[5] != cut.keys[6] and cut.keys[4:7].tolist() == cut.keys[9:12].tolist()
    assert not set(cut.keys[4:7].tolist()) & set(lm_scoring.units(lm_texts("x" * 16)).keys.tolist())
    assert cut.tokens[4] == cut.tokens[7] and len(set(cut.tokens.tolist())) == 5


def test_lm_spelling_is_a_distribution():
    rng = np.random.default_rng(1)
    codes, n = lm_scoring.totals(rng.integers(0, 4, 500) << 24 | rng.integers(0, 4, 500) << 16 | rng.integers(0, 4, 500) << 8 | rng.integers(0, 9, 500), np.ones(500, np.int64))
    for spelling in (lm_scoring.Spelling(codes, n), lm_scoring.Spelling(codes[:0], n[:0])):
        for context in (0, 0x010203, 0xFFFFFF, 0x00FF01):
            assert np.exp(spelling.logs(context << 8 | np.arange(256))).sum() == pytest.approx(1)
    cut = lm_scoring.units(lm_texts("ab"))
    codes, bounds = lm_scoring.quads(cut.spans, np.array([0]), cut.last)
    assert [int(c).to_bytes(4) for c in codes] == [b"\0\0 a", b"\0 ab", b" ab "] and bounds.tolist() == [0, 3]


def plain_score(text, model, counts):
    """The model's natural log probability of a text, unit by unit, with loops."""
    words, w = model.words, lm_scoring.split(model.weights.astype(float))
    cut = lm_scoring.units(lm_texts(text))
    ids, total, spans = words.identify(cut.keys), 0.0, 0

    def softmax(x):
        e = np.exp(x - x.max())
        return e / e.sum()

    for u, (key, unit) in enumerate(zip(cut.keys.tolist(), ids.tolist(), strict=True)):
        # the window that scores a unit: the first, or the one whose last STRIDE places hold it
        start = 0 if u < lm_scoring.WINDOW else -(-(u - lm_scoring.WINDOW + 1) // lm_scoring.STRIDE) * lm_scoring.STRIDE
        before = [lm_scoring.BEGIN if p == 0 else int(ids[p - 1]) for p in range(start, u + 1)]
        x = np.array([w["embed"][b] + w["place"][p] for p, b in enumerate(before)])
        query = x[-1] @ w["q"]
        a = softmax(np.array([query @ (row @ w["k"]) for row in x]) / lm_scoring.WIDTH**0.5)
        h = x[-1] + sum(share * (row @ w["v"]) for share, row in zip(a, x, strict=True))
        outcome = softmax(h @ w["out"] + w["bias"])
        if unit < lm_scoring.LISTED:
            cluster, member = divmod(unit, lm_scoring.MEMBERS)
            total += np.log(outcome[cluster]) + np.log(softmax(h @ w["inner"][cluster] + w["inner_bias"][cluster])[member])
        else:
            kind = unit - lm_scoring.LISTED
            total += np.log(outcome[lm_scoring.CLUSTERS + kind])
            if key in counts:
                total += np.log(counts[key]) - words.whole[kind]
            else:
                codes, _ = lm_scoring.quads(cut.spans, np.array([spans]), cut.last)
                total += words.unseen[kind] + sum(float(words.spelling.logs(codes[i : i + 1])[0]) for i in range(len(codes)))
        spans += key != lm_scoring.END
    return total / np.log(10)


def test_lm_scores_equal_a_plain_model(spark):
    rng = random.Random(8)
    words = [f"{rng.choice('bdfg')}{rng.choice('aeiou')}{k}{'x' * (k % 25)}" for k in range(2600)]
    rows = [(i, " ".join(words[min(int(rng.expovariate(1 / 700)), 2599)] for _ in range(rng.choice([0, 3, 31, 32, 33, 150])))) for i in range(160)]
    rows += [(500 + i, f"never{i} seen{'y' * 40}{i} " + rows[5][1]) for i in range(30)]
    staged = lm_scoring.staged_texts(text_docs(spark, rows))
    model = lm_scoring.fit(staged)
    counts = {r["key"]: r["n"] for r in model.counts.collect()}
    out = by_id(lm_scoring.score_staged(staged, model))
    assert len(model.words.keys) > 1000
    for doc, text in rows:
        assert out[doc]["score"] / np.log(10) == pytest.approx(plain_score(text, model, counts), rel=2e-4), doc


def test_lm_held_out_scores_beat_the_base(spark):
    rng, follows = random.Random(2), {}
    names = [f"w{k}" for k in range(120)]
    for name in names:
        follows[name] = rng.sample(names, 3)

    def text():
        word, out = rng.choice(names), []
        for _ in range(400):
            out.append(word)
            word = rng.choice(follows[word])
        return " ".join(out)

    out = lm_scoring.score_documents(text_docs(spark, [(i, text()) for i in range(600)]).coalesce(1)).where("held_out").collect()
    base, score = sum(r["base_score"] for r in out), sum(r["score"] for r in out)
    assert len(out) > 30 and score > 0.92 * base, score / base


def test_lm_gradient():
    rng = np.random.default_rng(0)
    shapes = lm_scoring.initial(rng.normal(0, 1, lm_scoring.OUTCOMES), rng.normal(0, 1, (lm_scoring.CLUSTERS, lm_scoring.MEMBERS)))
    weights = shapes.astype(np.float64) + rng.normal(0, 0.1, len(shapes))
    ids = np.append(rng.integers(0, 200, 40), rng.integers(lm_scoring.LISTED, lm_scoring.BEGIN, 10))
    before, target, real = lm_scoring.windows(ids, np.array([0, 0]), np.array([0, 30]), np.array([50, 50]))

    def loss(w):
        w = lm_scoring.split(w)
        chances = lm_scoring.log_chances(w, lm_scoring.attend(w, before)[0].reshape(-1, lm_scoring.WIDTH), target.ravel())
        return -(chances * real.ravel()).sum() / real.sum()

    slope = lm_scoring.gradient(lm_scoring.split(weights), before, target, real)
    nonzero = np.flatnonzero(np.abs(slope) > 1e-4)
    for at in [*rng.integers(0, len(weights), 20), *rng.choice(nonzero, 60)]:
        step = np.zeros_like(weights)
        step[at] = 1e-5
        assert slope[at] == pytest.approx((loss(weights + step) - loss(weights - step)) / 2e-5, rel=1e-3, abs=1e-6)


def test_lm_trains_on_every_unit_once(spark, docs, monkeypatch):
    words = lm_scoring.vocabulary(lm_scoring.count_units(lm_scoring.unit_rows(lm_scoring.staged_texts(docs))))
    data = np.frombuffer(" ".join(f"w{k}" for k in range(999)).encode() + b"a b", np.uint8)
    texts = lm_scoring.Texts(data, np.array([0, len(data) - 3, len(data) - 3, len(data)]))
    want, seen = lm_scoring.units(texts), []

    def gradient(w, before, target, real):
        seen.append(real.sum())
        return np.zeros(len(lm_scoring.initial(words.outcome_prior, words.member_prior)), np.float32)

    class Frame:
        sparkSession = spark

        def select(self, *_):
            return self

        def mapInArrow(self, run, schema):
            array = pa.array([data[:-3].tobytes(), None, data[-3:].tobytes()], pa.binary())
            return spark.createDataFrame([(b.column(0)[0].as_py(), b.column(1)[0].as_py()) for b in run([pa.record_batch([array], ["text"])])], schema)

    monkeypatch.setattr(lm_scoring, "gradient", gradient)
    lm_scoring.train(Frame(), words)
    assert sum(seen) == len(want.keys)


def test_lm_windows_score_each_unit_once_and_causally():
    weights = lm_scoring.initial(np.zeros(lm_scoring.OUTCOMES), np.zeros((lm_scoring.CLUSTERS, lm_scoring.MEMBERS)))
    ids = np.random.default_rng(1).integers(0, lm_scoring.BEGIN, 200)
    whole = lm_scoring.score_windows(weights, ids, np.array([0, 0, 70, 200]))
    assert (whole < 0).all()
    changed = ids.copy()
    changed[60:] = 0
    assert np.allclose(lm_scoring.score_windows(weights, changed, np.array([0, 0, 70, 200]))[:60], whole[:60], atol=1e-5)


def check_pieces(out, rows):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=queries.vocabulary("piece_bpe_32k.model"))
    for doc, text in pairs(rows):
        ids, r = library.encode(text or ""), out[doc]
        assert r["agrees"] and r["n_tokens"] == len(ids), doc
        assert r["ids_sha256"] == sha(",".join(map(str, ids))) and r["decoded_sha256"] == sha(library.decode(ids))


def test_piece_agendas(spark, docs, odd, empty, rows):
    model = queries.vocabulary("piece_bpe_32k.model")
    check_pieces(by_id(piece_agenda.encode_documents(docs, model)), rows)
    assert piece_agenda.encode_documents(odd, model).where("agrees").count() == odd.count()
    assert piece_agenda.encode_documents(empty, model).collect() == []
    kept = by_id(piece_agenda.encode_documents(docs, model, keep=True))
    assert kept[0]["ids"] == [] and kept[0]["decoded"] == "" and kept[4]["decoded"] == "One  TWO three"
    check_pieces(by_id(queries.op11_piece_agenda(spark, SF_DIR)), [(r["doc_id"], r["text"]) for r in table(spark, "documents").collect()])


def test_piece_agendas_on_random_characters():
    import sentencepiece

    model = queries.vocabulary("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    with open(model, "rb") as file:
        agenda = piece_agenda.PieceAgenda(file.read())
    rng = random.Random(1)
    signs = ["a", "b", " ", "  ", "\u2581", "\n", "\t", "é", "日本", "🎉", "\x00", "\u0301", "ﬁ", "1", "\ufffd", "<0x0A>", "</s>", "<unk>", "\u00a0", "the", "ing", "\r", "\ue000"]
    for _ in range(1500):
        odd_ones = [rng.randrange(1, 0x3000), rng.randrange(0x10000, 0x1FFFF)]
        text = "".join(rng.choice(signs) if rng.random() < 0.7 else chr(rng.choice(odd_ones)) for _ in range(rng.randrange(80)))
        ids = memoryview(agenda.encode([text])[0]).cast("i").tolist()
        assert ids == library.encode(text) and agenda.decode(ids) == library.decode(ids), repr(text)
    for _ in range(300):
        ids = [rng.choice([rng.randrange(0, 259), rng.randrange(3, 32000)]) for _ in range(rng.randrange(1, 12))]
        assert agenda.decode(ids) == library.decode(ids), ids
    long = "x" * 60_000 + " " * 900 + "日本語" * 3000
    assert memoryview(agenda.encode([long])[0]).cast("i").tolist() == library.encode(long)
    assert agenda.encode([None, ""]) == [b"", b""]


def test_piece_agendas_take_the_leftmost_of_equal_scores():
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(queries.vocabulary("piece_bpe_32k.model"), "rb") as file:
        proto.ParseFromString(file.read())
    for piece in proto.pieces[300:]:
        piece.score = float(int(piece.score) // 400)
    import sentencepiece

    content = proto.SerializeToString()
    agenda, library = piece_agenda.PieceAgenda(content), sentencepiece.SentencePieceProcessor(model_proto=content)
    rng = random.Random(4)
    for _ in range(400):
        text = "".join(rng.choice("abcdeinorst  ") for _ in range(rng.randrange(60)))
        assert memoryview(agenda.encode([text])[0]).cast("i").tolist() == library.encode(text)


def test_centroids(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5] * 64), (1, [0.5] * 64), (None, [1.0] * 64), (None, [-1.5] * 64), (2, None), (3, [1.0] * 63), (4, [None] * 64), (5, [nan] * 64), (6, [inf] * 64)]
    rows += [(7, [3e38] * 64), (8, [-3e38] + [0.1] * 63), (9, [1e9] * 64), (10, []), *((100 + i, [0.25] * 64) for i in range(30))]
    rows += [(200 + i, [float((i * j) % 7) - 3 for j in range(64)]) for i in range(20)]
    schema = "vec_id long, embedding array<float>, cluster string, q string, p int"
    df = spark.createDataFrame([(i, v, "x", "y", 1) for i, v in rows], schema)
    fits = lambda x: x if x < 2**63 else None
    for frame, names in ((df, None), (table(spark, "embeddings"), None), (df.where("vec_id in (1, 100, 101, 205)"), None)):
        got = centroids.cluster_vectors(frame).drop("n_verified").collect()
        want = cluster([(r["vec_id"], r["embedding"]) for r in frame.collect()])
        assert sorted(map(tuple, got), key=str) == sorted(((i, c, fits(d), fits(a), fits(b), h) for i, c, d, a, b, h in want), key=str)
    assert centroids.cluster_vectors(df.limit(0)).collect() == [] and centroids.cluster_vectors(df.where("vec_id = 3")).collect() == []


def test_centroid_bounds_hold_and_save_work(spark):
    rng = np.random.default_rng(3)
    q = np.floor(1024 * (rng.normal(0, 0.02, (4000, 64)) + rng.normal(0, 0.3, (8, 64))[rng.integers(0, 8, 4000)]))
    whole = [[int(x) for x in row] for row in q[:8]]
    for share in (0.3, 0.9, 1.0):
        covariance = np.cov(q.T)
        axes = np.linalg.eigh(covariance)[1][:, ::-1].T[: max(1, int(64 * share))]
        model = centroids.Centroids(whole, centroids.Rotation(q.mean(0), np.ascontiguousarray(axes)))
        leading, left, norm = centroids.Rotation(q.mean(0), axes).turn(q)
        number, best, verified, _ = model.nearest(q, leading.astype(np.float32).astype(float), left, norm)
        distances = ((q[:, None, :] - np.array(whole)[None]) ** 2).sum(2).astype(np.int64)
        assert (number == distances.argmin(1)).all() and (best == distances.min(1)).all()
        assert verified.mean() < 5
    assert [centroids.limbs(x) for x in (0, -1, 5, 2**40)] == [[0], [-1], [5], [0, 1]]
    assert all(sum(limb << (40 * k) for k, limb in enumerate(centroids.limbs(x))) == x for x in (-(2**200) - 7, 2**130 + 3, -(2**40), 2**63))


def trie_rows(seed, n, letters, longest, convs):
    rng = random.Random(seed)
    return [
        (c, t or None, rng.choice(["u", "a", None]) if rng.random() < 0.1 else "u", rng.choice(letters))
        for c in rng.sample(range(-250, convs), n) for t in range(rng.randrange(longest))
    ]


@pytest.mark.parametrize(
    "rows, width",
    [
        (trie_rows(1, 200, ["x", "yy", None, "é"], 7, 400), 64), (trie_rows(2, 120, ["x"], 14, 400), 3),
        (trie_rows(3, 30, ["x", "yy"], 40, 100) + [(c, t, "u", "x") for c, n in ((7000, 100), (7100, 100), (7200, 60)) for t in range(n)], 3),
        ([(5, None, "u", "x")], 64), ([], 64),
    ],
)
def test_prefix_tries(spark, rows, width):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, part int, band string").repartition(3)
    found = Counter(map(tuple, prefix_trie.prefix_trie(df, width).collect()))
    assert found == Counter(trie_nodes(rows))


def test_prefix_tries_of_repeated_rows_and_null_ids(spark):
    rows = [(3, 0, "u", "a"), (3, 0, "u", "a"), (None, 0, "u", "a"), (4, 0, None, None), (4, 1, "u", "b" * 50_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {(r["conv_id"], r["depth"]): r for r in prefix_trie.prefix_trie(df).collect()}
    # crc32 of 3 and 4, modulo 6, take nothing from conversation 0, which is absent, and leave out so many own turns
    own = {c: max(0, 2 - crc(c) % 6) for c in (3, 4)}
    assert found[(3, 0)]["n_convs"] == 2 and sum(depth > 0 for _, depth in found) == sum(own.values())


def test_prefix_tries_of_one_conversation_over_many_ranges(spark):
    rows = [(7_000, t, "u", f"t{t % 5}") for t in range(3000)] + [(7_100, t, "u", f"t{t % 5}") for t in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    shape = prefix_trie.numbered(df).groupBy("conv").agg(F.count("*").alias("n"), F.countDistinct("pos").alias("m"), F.max("pos").alias("top")).collect()
    assert sorted(map(tuple, shape)) == [(7000, 3000, 3000, 2999), (7100, 3000, 3000, 2999)]
    found = prefix_trie.prefix_trie(df).agg(F.count("*"), F.max("depth"), F.sum("saved_tokens"), F.max("n_leaves")).first()
    assert found[0] == 3001 and found[1] == 3000 and found[3] == 1
    assert found[2] == 2 * sum(range(1, 3001)) + 2 * 3000


def check_rules(out, rows):
    for doc, text in pairs(rows):
        r, want = out[doc], base_rules(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r["kept"] and r["base_failed"])


def test_quality_rules(spark, docs, odd, empty, rows):
    documents, labels = table(spark, "documents"), table(spark, "labels")
    field = quality_rules.fit_lines(documents, labels)
    check_rules(by_id(quality_rules.quality_rules(docs, field)), rows)
    assert quality_rules.quality_rules(odd, field).count() == odd.count()
    assert quality_rules.quality_rules(empty, field).collect() == []
    out = by_id(queries.op3_quality_rules(spark, SF_DIR))
    check_rules(out, [(r["doc_id"], r["text"]) for r in documents.collect()])
    good = [out[r["doc_id"]] for r in labels.where("quality = 1").collect()]
    assert np.mean([r["kept"] for r in good if not r["base_failed"]]) > 0.95
    untaught = quality_rules.fit_lines(empty, labels.limit(0))
    assert all(r["kept"] != r["base_failed"] for r in quality_rules.quality_rules(docs, untaught).collect())


def test_line_fields_learn_changes_inside_documents(spark):
    rng = random.Random(6)
    prose = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(12)) + "."
    junk = "### $$$ ||| *** {} &&& <<>> ###"
    good = [(i, "\n".join([prose() for _ in range(6)] + [junk.format(k) for k in range(4)])) for i in range(40)]
    bad = [(100 + i, "\n".join(junk.format(f"{i}{k}") for k in range(8))) for i in range(40)]
    docs = spark.createDataFrame([*good, *bad, good[0], (500, "x\n" * 5000), (None, "y")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(500, 1), (500, 0), (1, None), (None, 1)], "doc_id long, quality int")
    field = quality_rules.fit_lines(docs, labels)
    # both labels are kept rather than changed, and a change is no rarer than the sample has it
    assert field.transition[0, 0] + field.transition[1, 1] > field.transition[0, 1] + field.transition[1, 0]
    out = by_id(quality_rules.quality_rules(docs, field))
    assert all((out[i]["n_content_lines"], out[i]["kept"]) == (6, True) for i, _ in good)
    assert all(out[i]["n_content_lines"] == 0 and not out[i]["kept"] for i, _ in bad)
    few = quality_rules.fit_lines(docs, labels, most=30)
    assert np.isfinite(few.emission).all() and (quality_rules.fit_lines(docs, labels, longest=0).emission == 0).all()


def test_viterbi_finds_the_best_sequence():
    rng = np.random.default_rng(3)
    for _ in range(30):
        field = quality_rules.LineField(rng.normal(size=quality_rules.FEATURES), rng.normal(size=(2, 2)))
        features = rng.normal(size=(6, quality_rules.FEATURES))
        labels = [[(k >> i) & 1 for i in range(6)] for k in range(64)]
        value = [sum(features[i] @ field.emission * x[i] for i in range(6)) + sum(field.transition[a, b] for a, b in zip(x, x[1:], strict=False)) for x in labels]
        assert quality_rules.decode(field, features, np.array([0, 0, 6])).astype(int).tolist() == labels[int(np.argmax(value))]


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(queries.vocabulary())


def check_ids(out, rows, library):
    for doc, text in pairs(rows):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert out[doc]["n_tokens"] == len(ids) and out[doc]["decoded_sha256"] == sha(library.decode(ids, skip_special_tokens=False))
        assert out[doc]["ids"] == ids


def test_byte_pairs(spark, docs, odd, empty, rows, library):
    check_ids(by_id(byte_pairs.encode_documents(docs, queries.vocabulary(), keep=True)), rows, library)
    documents = table(spark, "documents")
    check_ids(by_id(byte_pairs.encode_documents(documents, queries.vocabulary(), keep=True)), [(r["doc_id"], r["text"]) for r in documents.collect()], library)
    assert byte_pairs.encode_documents(odd, queries.vocabulary()).count() == odd.count()
    assert byte_pairs.encode_documents(empty, queries.vocabulary()).collect() == []


def test_byte_pairs_on_random_letters(library):
    with open(queries.vocabulary(), encoding="utf-8") as file:
        pairs_ = byte_pairs.from_json(file.read())
    rng = random.Random(1)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for _ in range(400):
        text = "".join(rng.choice([chr(rng.choice(points)), "<|endoftext|>", " ", "  ", "\n", "é", "the", "'s", "aaaa", "͸"]) for _ in range(30))
        ids = library.encode(text, add_special_tokens=False).ids
        assert list(memoryview(pairs_.encode(text)).cast("I")) == ids
        assert pairs_.decode(pairs_.encode(text)) == library.decode(ids, skip_special_tokens=False)


def test_line_runs_are_sorted_and_merge(spark):
    runs = dedup.LineRuns(spark, fan_in=3)
    keys = lambda low, high: spark.range(low, high).select(F.xxhash64("id").alias("h1"), F.xxhash64("id", "id").alias("h2"), F.col("id").alias("ident"))
    for low, high in ((0, 2000), (1000, 2500)):
        runs.add(keys(low, high).union(keys(low, high)))

    def files(path):
        return [name for name in os.listdir(path) if name.endswith(".parquet")]

    def plan(df):
        with dedup.ordered_scans(spark):
            return df._jdf.queryExecution().executedPlan().toString()

    assert [len(files(path)) for level in runs.levels for _, path in level] == [runs.buckets] * 2
    anti = plan(runs.fresh(keys(0, 10)))
    # the new keys are gathered and sorted once; neither run is
    assert anti.count("SortMergeJoin") == 2 and anti.count("Exchange hashpartitioning") == 1 and anti.count("- Sort [") == 1
    merge = plan(runs.merged(runs.levels[0]))
    assert "FullOuter" in merge and "Exchange" not in merge and "Sort [" not in merge
    runs.add(keys(2400, 4000))
    assert [len(level) for level in runs.levels] == [0, 1]
    assert len(files(runs.levels[1][0][1])) == runs.buckets
    owners = {r["h1"]: r["owner"] for r in runs.owners().collect()}
    assert owners == {r["h1"]: r["ident"] for r in keys(0, 4000).collect()}
    runs.add(keys(3999, 4001))
    assert runs.owners().count() == 4001
    runs.close()


def test_line_dedup(spark, docs, odd, empty, rows):
    want = {doc: rest for doc, *rest in line_dedup(pairs(rows))}
    for batches in (1, 3, 7):
        out = dedup.dedup_lines(docs, batches).collect()
        assert {r["row"]["doc_id"]: [r["n_lines"], r["n_dropped"], r["row"]["text"] or ""] for r in out} == want
        assert out[0]["row"].asDict().keys() == set(docs.columns)
    assert dedup.dedup_lines(empty).collect() == []
    out = dedup.dedup_lines(odd).collect()
    assert len(out) == odd.count()
    nulls = [r["row"]["text"] for r in out if r["row"]["doc_id"] is None]
    assert sorted(nulls, key=str) == ["", None]


def check_components(out, rows):
    for doc, n, component in components(pairs(rows)):
        assert (out[doc]["n_shingles"], out[doc]["component_id"]) == (n, component)


def test_jaccard_join(spark, docs, odd, empty, rows, monkeypatch):
    check_components(by_id(jaccard_join.jaccard_components(docs)), rows)
    assert jaccard_join.jaccard_components(empty).collect() == []
    out = jaccard_join.jaccard_components(odd).collect()
    assert len(out) == odd.count()
    assert sorted((r["component_id"] for r in out if r["doc_id"] is None), key=str) == [7, None]
    # one leader and tiny blocks leave nearly all pairs to the later steps
    monkeypatch.setattr(jaccard_join, "LEADERS", 1)
    monkeypatch.setattr(jaccard_join, "BLOCK", 2)
    monkeypatch.setattr(jaccard_join, "CROWDED", 1)
    check_components(by_id(jaccard_join.jaccard_components(docs)), rows)


def test_jaccard_join_on_the_tables(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, "documents").collect()]
    check_components(by_id(queries.op7_jaccard_join(spark, SF_DIR)), rows)


def test_connected_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)] + [(7, 7)]
    parent = {x: x for link in links for x in link}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    out = {r["node"]: r["root"] for r in connect(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {x: root(x) for x in out} and len(out) >= 100


def check_contamination(out, rows, items):
    for doc, text in pairs(rows):
        r = out[doc]
        assert (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) == contamination(text, items)


@pytest.mark.parametrize("block", [1 << 24, 40])
def test_decontamination(spark, docs, odd, empty, rows, block):
    base = rows[7][1].split(" ")
    items = [(1, " ".join(base[10:40])), (2, "one"), (3, ""), (4, None), (11, " ".join(base[10:40]).upper()), (5, "école école"), (6, "no such words anywhere here")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    find = lambda df: decontamination.find_matches(df, benchmark, block=block)
    out = find(docs).select("row.doc_id", "n_words", "n_hit", "items", "contaminated", "matches").collect()
    check_contamination({r["doc_id"]: r for r in out}, rows, items)
    match = next(m for r in out if r["doc_id"] == 7 for m in r["matches"] if m["item_id"] == "1")
    assert (match["doc_word"], match["item_word"], match["n_words"]) == (10, 0, 30)
    assert find(odd).count() == odd.count() and find(empty).collect() == []
    assert decontamination.find_matches(docs, benchmark.limit(0)).where("n_hit > 0").count() == 0


def test_every_passage_is_found_with_its_places(spark):
    words = [f"w{k}" for k in range(60)]
    text = " ".join([*words[:20], "x", *words[5:30], "y", *words[:15], *words[40:60]])
    items = [("a", " ".join(words)), ("b", " ".join(words[2:18])), ("c", "short one")]
    docs = spark.createDataFrame([(1, text), (2, "a short one here")], "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    out = {r["row"]["doc_id"]: r for r in decontamination.find_matches(docs, benchmark).collect()}
    found = sorted((m["item_id"], m["doc_word"], m["item_word"], m["n_words"]) for m in out[1]["matches"])
    assert found == [("a", 0, 0, 20), ("a", 21, 5, 25), ("a", 47, 0, 15), ("a", 62, 40, 20), ("b", 2, 0, 16), ("b", 21, 3, 13), ("b", 49, 0, 13)]
    assert [tuple(m) for m in out[2]["matches"]] == [("c", 1, 0, 2)] and "matches" not in decontamination.find_matches(docs, benchmark, passages=False).columns


def test_texts_and_items_that_repeat_themselves(spark):
    docs = spark.createDataFrame([(1, "a " * 300_000), (2, "b"), (3, "a " * 12)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(k, "a " * 5000) for k in range(30)], "item_id long, text string")
    out = {r["doc_id"]: r for r in decontamination.find_matches(docs, benchmark, passages=False).select("row.doc_id", "n_hit", "items", "contaminated").collect()}
    assert out[1]["n_hit"] == 300_000 and len(out[1]["items"]) == 30 and out[1]["contaminated"]
    assert [(out[k]["n_hit"], out[k]["items"], out[k]["contaminated"]) for k in (2, 3)] == [(0, [], False)] * 2


def test_quality_classifier(spark, docs, odd, empty):
    out = queries.op9_quality_classifier(spark, SF_DIR).collect()
    labels = {r["doc_id"]: r["quality"] for r in table(spark, "labels").collect()}
    held = [(r["predicted"], labels[r["doc_id"]]) for r in out if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([a == b for a, b in held]) > 0.9
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (crc(r["doc_id"]) % 4 == 2) for r in out)
    vectors = quality_classifier.features(docs).withColumn("quality", (F.col("doc_id") % 2).cast("int"))
    model = quality_classifier.fit(vectors)
    assert quality_classifier.score_documents(odd, model).count() == odd.count()
    assert quality_classifier.score_documents(empty, model).collect() == []
    untaught = quality_classifier.fit(vectors.limit(0))
    assert {r["score"] for r in quality_classifier.score_documents(docs, untaught).collect()} == {0.5}


def test_languages(spark, docs, odd, empty):
    langs = {r["doc_id"]: r["lang"] for r in table(spark, "documents").collect()}
    out = queries.op10_languages(spark, SF_DIR).collect()
    held = [r["lang_pred"] == langs[r["doc_id"]] for r in out if r["held_out"]]
    assert np.mean(held) > 0.9 and all(0 <= r["score"] <= 1 for r in out)
    model = languages.learn(docs)
    found = by_id(languages.identify(docs, model, keep_spans=True))
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 for i in (0, 1, 2))
    assert languages.identify(odd, model).count() == odd.count() and languages.identify(empty, model).collect() == []
    assert {r["lang_pred"] for r in languages.identify(docs, languages.learn(empty)).collect()} == {"und"}


def test_language_spans(spark):
    documents = table(spark, "documents")
    model = languages.learn(documents)
    en, de = (documents.where(f"lang = '{x}' and n_chars > 400").orderBy("doc_id").first()["text"][:300].replace("\n", " ") for x in ("en", "de"))
    mixed = spark.createDataFrame([(1, f"{en} {de}")], "doc_id long, text string")
    spans = languages.identify(mixed, model, keep_spans=True).first()["spans"]
    assert [s["lang"] for s in spans] == ["en", "de"]


def test_pipeline_stages_do_what_the_plain_versions_do(spark, docs, odd, empty):
    stages = dict(corpus_pipeline.STAGES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "jaccard_join", "decontamination", "byte_pairs"]
    docs_ = table(spark, "documents")
    for name, function in corpus_pipeline.STAGES[:-1]:
        before = [(r["doc_id"], r["text"]) for r in docs_.collect()]
        kept = function(spark, docs_, SF_DIR)
        assert kept.columns == docs_.columns
        docs_ = corpus_pipeline.stage(kept, "test")
        after = {r["doc_id"]: r["text"] for r in docs_.collect()}
        if name == "line_dedup":
            assert after == {doc: text for doc, _, dropped, text in line_dedup(before) if not dropped or text.strip(" \t\n\r\x0b\x0c")}
        if name == "jaccard_join":
            assert set(after) == {doc for doc, _, component in components(before) if doc == component}
        if name == "decontamination":
            items = [(r["item_id"], r["text"]) for r in table(spark, "benchmark").collect()]
            assert set(after) == {doc for doc, text in before if not contamination(text, items)[3]}
    assert stages["byte_pairs"](spark, docs_, SF_DIR).count() == len(after)
    for name, function in corpus_pipeline.STAGES:
        assert function(spark, empty, SF_DIR).count() == 0, name
        assert function(spark, odd, SF_DIR).count() <= odd.count(), name


def test_quality_scores_equal_a_plain_discriminant(spark):
    documents = [(r["doc_id"], r["text"]) for r in table(spark, "documents").collect()]
    labels = [(r["doc_id"], r["quality"]) for r in table(spark, "labels").collect()]
    want, out = quality_scores(documents, labels), by_id(queries.op9_quality_classifier(spark, SF_DIR))
    assert set(out) == set(want)
    for doc, score in want.items():
        assert out[doc]["score"] == pytest.approx(score, rel=1e-6, abs=1e-9), doc
        assert out[doc]["held_out"] == (crc(doc) % 4 == 2) and out[doc]["predicted"] == (out[doc]["score"] >= 0.7)


def test_languages_equal_a_plain_viterbi(spark, rows):
    documents = [(r["doc_id"], r["text"], r["lang"]) for r in table(spark, "documents").collect()]
    out = by_id(queries.op10_languages(spark, SF_DIR))
    for doc, (lang, score, n_spans) in plain_languages(documents, languages.SCRIPTS).items():
        r = out[doc]
        assert (r["lang_pred"], r["n_spans"], r["held_out"]) == (lang, n_spans, crc(doc) % 3 == 1), doc
        assert r["score"] == pytest.approx(score, abs=1e-9), doc
