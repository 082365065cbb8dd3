"""Each operator against its plain-Python version on a messy table, an empty one, and sf0.001."""

import math
import os
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickmart.llm import (_store, _words, co_training, decontaminate, language, line_quality, packing, phrase_dedup, sharding, simhash,
                           token_count, url_filter)
from clickmart.llm._store import ship_package
from clickmart.llm.queries import block_list
from tests.llm import brute
from tests.llm.fixtures import CLASHING, empty, messy, messy_rows, same_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    return messy(spark).cache()


@pytest.fixture(scope="module")
def rows():
    return messy_rows()


def test_word_hashes_follow_the_patterns(rows):
    texts = [r[1] for r in rows]
    for table, pattern, fold in ((_words.SPACED, brute.SPACED, False), (_words.ALNUM, brute.ALNUM, True)):
        data, offsets = _words.utf8(pa.array(texts, pa.string()))
        buf = _words.LOWER[data] if fold else data
        starts, ends, first = _words.words(buf, offsets, table)
        expected = [pattern.findall((t or "").translate(brute.LOWER) if fold else (t or "")) for t in texts]
        assert np.diff(first).tolist() == [len(w) for w in expected]
        flat = [w for doc in expected for w in doc]
        assert [buf[a:b].tobytes().decode() for a, b in zip(starts, ends)] == flat
        h = _words.hashes(buf, starts, ends)
        assert len(set(h.tolist())) == len(set(flat)) == len(set(zip(flat, h.tolist())))
    for n in (1, 2, 5, 8, 13, 20):
        g = _words.grams(h, n)
        windows = [tuple(flat[i:i + n]) for i in range(len(flat) - n + 1)]
        assert len(set(g.tolist())) == len(set(windows)) == len(set(zip(windows, g.tolist())))


def check_shards(out, rows, n_shards):
    size = Counter()
    slots = defaultdict(list)
    for r in out:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(size) <= set(range(n_shards))
    same_rows([(r["doc_id"], r["size"], r["text_crc32"]) for r in out],
              [(r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows])
    return size


def test_shards(docs, rows, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_GROUP", 3)
    rows = [r for r in rows if r[0] != 108]  # its longest text alone is larger than a shard
    few = docs.where("doc_id is null or doc_id <> 108")
    for options in ({}, {"range_bytes": 500, "min_ranges": 4, "samples_per_range": 4}, {"min_ranges": 1}):
        out = sharding.shard(few, n_shards=6, **options).collect()
        size = check_shards(out, rows, 6)
        assert max(size.values()) - min(size.values()) <= 2 * max(len((r[1] or "").encode()) + 8 for r in rows)
        assert set(out[0].asDict()) == {"doc_id", "text", "lang", "source", "n_chars", *sharding.OUT, *CLASHING}
    texts = {r["shard"]: r for r in sharding.shard(few, n_shards=2).where(F.col("text") == rows[6][1]).collect()}
    assert len(texts) <= 2


def test_shards_are_written(spark, docs, tmp_path):
    sharded = sharding.shard(docs.select("doc_id", "text"), n_shards=3)
    sharding.write_shards(sharded, str(tmp_path / "out"))
    same_rows(spark.read.parquet(str(tmp_path / "out")).select("doc_id", "text", "shard", "slot").collect(),
              sharded.select("doc_id", "text", "shard", "slot").collect())


def test_line_frequency(docs, rows):
    out = line_quality.judge_lines(docs, min_docs=10, max_percent=20, min_left_percent=50)
    stats = [brute.base_stats(r[1]) for r in rows]
    verdicts = brute.line_verdicts([(r[0], r[1], r[3]) for r in rows], 10, 20, 50)
    assert len({v for _, v in verdicts}) == 2 and any(g for g, _ in verdicts)
    same_rows(out.select("doc_id", *line_quality.STATS, "base_failed", "n_removed_words", "kept").collect(),
              [(r[0], *s, *v) for r, s, v in zip(rows, stats, verdicts)])
    for r in out.collect():
        assert len(brute.SPACED.findall(r["text_kept"])) == r["n_words"] - r["n_removed_words"]


def test_a_repeated_row_counts_once(spark):
    """Of 100 words a frequent line has 40: kept, whether the row stands once or twice."""
    line = " ".join(f"w{i}" for i in range(40))
    rows = [(i, line + "\n" + " ".join(f"x{i}y{k}" for k in range(60)), "h") for i in range(41)]
    df = spark.createDataFrame(rows + rows[:1], "doc_id long, text string, source string").withColumns({"r_doc": F.lit(1), "r_host": F.lit(2), "l": F.lit(3)})
    got = line_quality.judge_lines(df).select("doc_id", "n_removed_words", "kept", "r_doc", "r_host").collect()
    assert len(got) == 42 and {tuple(r)[1:] for r in got} == {(40, True, 1, 2)}


def test_line_frequency_is_native(docs):
    plan = line_quality.judge_lines(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_repeated_phrases(docs, rows):
    got = phrase_dedup.remove_repeats(docs, block_bytes=3000)
    key = {(r["doc_id"], r["text"]): r["k"] for r in docs.select("doc_id", "text", phrase_dedup._block_key().alias("k")).collect()}
    distinct = sorted({(r[0], r[1]) for r in rows}, key=lambda r: (r[0] is None, r[0] or 0, key[r]))
    result = dict(zip(distinct, brute.remove_repeats(distinct)))
    assert 20 < sum(v[1] > 0 for v in result.values()) < len(result)
    same_rows(got.select("doc_id", "text", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256)).collect(),
              [(r[0], r[1], *result[r[0], r[1]]) for r in rows])


def one_block(rows):
    """Rows (doc_id, text) as one block, and the phrases of all its seeds, as if each occurred in other blocks too."""
    texts = [r[1] or "" for r in rows]
    block = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": texts,
                      phrase_dedup._KEY: pa.array([zlib.crc32(t.encode()) for t in texts], pa.int64()),
                      phrase_dedup._BLOCK: pa.array([0] * len(rows), pa.int32())})
    seeds = pa.concat_tables(pa.Table.from_batches([b]) for b in phrase_dedup._seed_rows(iter(
        block.select(["text", phrase_dedup._BLOCK]).to_batches())))
    return block, phrase_dedup._phrases(block, seeds)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 10**6])
def test_first_blocks_of_seeds_as_a_stream(size):
    """Seeds of two or more blocks with the first of them, however the rows come in batches."""
    rng = np.random.default_rng(size)
    rows = sorted(zip(rng.integers(-20, 20, 150).tolist(), rng.integers(0, 4, 150).tolist()))
    rows = [r for r in rows if r[0] % 3 or r[1] == r[0] % 4]  # some seeds with one block
    rows = [r for i, r in enumerate(rows) if r[0] % 5 or rows[i - 1][0] != r[0]]  # some with one row
    blocks = defaultdict(set)
    for seed, block in rows:
        blocks[seed].add(block)
    table = pa.table({"seed": [r[0] for r in rows], "block": pa.array([r[1] for r in rows], pa.int32())})
    got = [tuple(r.values()) for b in phrase_dedup._homes(iter(table.to_batches(max_chunksize=size))) for r in b.to_pylist()]
    assert sorted(got) == sorted((s, min(b)) for s, b in blocks.items() if len(b) > 1) and 0 < len(got) < len(blocks)


def test_the_automaton_finds_every_occurrence(rows):
    """Phrases of other documents are found at each place where their words stand, and nowhere else."""
    texts = [r[1] or "" for r in rows]
    half = rows[::2] + [(None, "  ".join(f"q{i}" for i in range(30)))]
    phrases = one_block(half)[1].column("phrase").to_pylist()
    b = phrase_dedup.Block(one_block(rows)[0])
    located = b.locate(phrases)
    of = {tuple(p.split()) for p in phrases}
    expected = set()
    for d, (doc_id, text) in enumerate(dict.fromkeys((r[0], t) for r, t in zip(rows, texts))):
        w = text.encode().split()
        expected |= {(doc_id, text, i) for i in range(len(w) - 7) if tuple(w[i:i + 8]) in of}
    docs_in_order = list(dict.fromkeys((r[0], t) for r, t in zip(rows, texts)))
    got = {(*docs_in_order[b.doc[i]], i - b.first[b.doc[i]]) for i in np.flatnonzero(located).tolist()}
    assert got == expected and len(got) > len(phrases) // 2
    assert not b.locate([]).any() and not b.locate([b"none of these eight words stands there anywhere"]).any()


def test_repeated_phrases_hold_in_small_steps(rows):
    """Marks do not depend on how segments come in batches."""
    block, phrases = one_block(rows)
    segments = phrase_dedup._segments(block, phrases)
    segments = pa.concat_tables([segments, segments.set_column(1, "doc_id", pa.array([10**6] * len(segments), pa.int64()))]).sort_by("content")
    whole, parts = ([b.to_pylist() for b in phrase_dedup._mark(iter(segments.to_batches(max_chunksize=n)))] for n in (10**6, 3))
    flat = [sorted(tuple(r.values()) for b in x for r in b) for x in (whole, parts)]
    assert flat[0] == flat[1] and flat[0]


def test_repeated_phrases_of_a_hot_seed(spark):
    """A passage in every document: its windows and those at its edges are spread, with one row for each window and block."""
    ship_package(spark)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, " ".join([*(f"a{i}x{k}" for k in range(25)), passage, *(f"b{i}x{k}" for k in range(25))])) for i in range(300)]
    windows = phrase_dedup._segments(*one_block(rows)).column("content").to_pylist()
    assert len(windows) == len(set(windows)) > 300
    got = phrase_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), block_bytes=4000)
    same_rows(got.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256)).collect(),
              [(i, *v) for (i, _), v in zip(rows, brute.remove_repeats(rows))])


def test_written_tables_can_be_dropped(spark, monkeypatch):
    """Only the tables that are recorded go; those of other tests are left."""
    monkeypatch.setattr(_store, "_WRITTEN", set())
    first, second = (_store.materialize(spark.range(5), name) for name in ("a", "b"))
    paths = [df.inputFiles()[0].removeprefix("file:").removeprefix("//") for df in (first, second)]
    assert first.count() == 5 and all(os.path.exists(p) for p in paths)
    _store.drop_tables(spark)
    assert not any(os.path.exists(os.path.dirname(p)) for p in paths) and not _store._WRITTEN
    _store.drop_tables(spark)


def test_repeated_phrases_shuffle_texts_and_seeds_once(spark):
    ship_package(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    out = phrase_dedup.remove_repeats(docs, block_bytes=20_000)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("MapInArrow _seed_rows") == 1 and plan.count("ReusedExchange") == 3


def test_token_counts(docs, rows):
    model = token_count.load_model(public_tokenizers.path("piece_bpe_32k.model"))
    expected = [len(x) for x in model.encode([r[1] or "" for r in rows])]
    out = token_count.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"), limit=100)
    same_rows(out.collect(), [(r[0], len((r[1] or "").encode()), n, n > 100) for r, n in zip(rows, expected)])


def test_pre_tokens_add_up():
    model = token_count.load_model(public_tokenizers.path("piece_bpe_32k.model"))
    texts = ["", " ", "  ", "\n", "\n\n", " \n ", "a\n", "\na", "a \n b", "▁", "▁ ▁a", " a  b   c ", "\t\t", "x" * 500, "\x00", "é\u0301", "a\r\nb",
             " " * 40, "don't 12345 stop", "<0x41>", "�", "\ufeff"]
    for t in texts:
        tokens = token_count.pre_tokens(t)
        assert "".join(tokens) == ("▁" + t.replace(" ", "▁") if t else "")
        assert sum(token_count.count_pieces(model, tokens)) == len(model.encode(t)), t


def test_language(spark, docs):
    ship_package(spark)
    known = spark.read.parquet(f"{SF}/documents.parquet")
    out = language.identify(known).join(known.select("doc_id", F.col("lang").alias("truth")), "doc_id").collect()
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in out)
    assert np.mean([r["lang_pred"] == r["truth"] for r in held]) >= 0.95
    model = language.fit(language.training_rows(known))
    for r in language.predict(docs, model).collect():
        assert 0 <= r["score"] <= 1 and r["kept"] == "clash"
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") != letters
    blind = language.predict(docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None).cast("string")), model)
    same_rows(blind.select("doc_id", "text", "lang_pred", "score").collect(), language.predict(docs, model).select("doc_id", "text", "lang_pred", "score").collect())


def test_language_equals_a_plain_version(spark):
    """Training rows, features, family and language votes and scores, with the same solver."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rows = [tuple(r) for r in docs.collect()] + [(10**6, None, "en"), (10**6 + 1, "", "de"), (10**6 + 2, "12 34 !", "fr"), (None, "le chat et la souris", "fr")]
    expected = brute.languages(rows, language.FAMILIES, lambda x, y: language.fit_svm(np.array(x), np.array(y, float)))
    got = language.identify(spark.createDataFrame(rows, docs.schema)).select("doc_id", "text", "lang_pred", "score").collect()
    found = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in got}
    assert len(got) == len(rows) and len({lang for lang, _ in expected}) >= 4
    for (doc_id, text, _), (lang, score) in zip(rows, expected):
        assert found[doc_id, text][0] == lang
        assert found[doc_id, text][1] == pytest.approx(score, abs=2e-4)


def test_language_needs_whole_texts_apart():
    """A text's score does not depend on its neighbours in the batch."""
    rng = np.random.default_rng(1)
    model = language.Model({"x": ["a", "b"]}, {("a", "b"): (rng.normal(size=language.DIMS).astype(np.float32), 0.1, 2.0)})
    texts = ["abc", "", "dé", "the quick brown fox", "z"]
    alone = [language.predict_batch(pa.array([t]), model)[1][0] for t in texts]
    assert np.allclose(language.predict_batch(pa.array(texts), model)[1], alone)
    for t, s in zip(texts, alone):
        w, b, slope = model.machines["a", "b"]
        p = 1 / (1 + np.exp(-slope * (language.features(t.encode()) @ w + b)))
        assert abs(max(p, 1 - p) - s) < 1e-5


def test_a_machine_is_fitted_without_copies_of_its_rows():
    rng = np.random.default_rng(3)
    x, y = rng.random((1000, language.DIMS)), np.repeat([-1.0, 1.0], 500)
    x[500:, :50] += 0.5
    tracemalloc.start()
    w, b, _ = language.fit_svm(x.copy(), y)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.3 * x.nbytes  # the copy made here; before, three more
    assert np.mean(np.sign(x @ w + b) == y) == 1


def test_training_rows_are_ordered_from_arrow_chunks():
    rng = np.random.default_rng(4)
    side, x = rng.choice([-1, 1], 70), rng.integers(0, 3, (70, language.DIMS)).astype(np.float32)
    parts = [pa.table({"side": pa.array(side[i:i + 20], pa.int32()), "x": pa.array([v.tobytes() for v in x[i:i + 20]], pa.binary())}).slice(1) for i in range(0, 70, 20)]
    got_side, got_x = language.training_matrix(pa.concat_tables(parts))
    kept = sorted((side[i], x[i].tobytes()) for i in range(70) if i % 20)
    assert got_side.tolist() == [s for s, _ in kept]
    assert [v.astype(np.float32).tobytes() for v in got_x] == [v for _, v in kept]


def test_simhash(docs, rows):
    out = simhash.near_duplicates(docs).select("doc_id", "fp", "component_id").collect()
    fps = [brute.fingerprint(r[1]) for r in rows]
    smallest = defaultdict(list)
    for label, r in zip(brute.components(fps), rows):
        smallest[label].append(r[0])
    named = {k: min((x for x in v if x is not None), default=None) for k, v in smallest.items()}
    same_rows([(r[0], r[1] % 2**64, r[2]) for r in out], [(r[0], f, named[k]) for r, f, k in zip(rows, fps, brute.components(fps))])
    kept = simhash.keep_first(docs).select("doc_id", "text").collect()
    assert len(kept) == len(smallest)


@pytest.mark.parametrize("piece", [20_000, 5])
def test_gray_index_finds_all_links(spark, piece):
    ship_package(spark)
    rng = np.random.default_rng(3)
    centers = rng.integers(0, 2**64, 40, dtype=np.uint64)
    fps = set(centers.tolist()) | {0, 2**64 - 1}
    for c in centers.tolist():
        for _ in range(15):
            for bit in rng.choice(64, rng.integers(1, 6), replace=False):
                c ^= 1 << int(bit)
            fps.add(c)
    fps = sorted(fps)
    rows = [(int(np.uint64(f).view(np.int64)),) for f in fps]
    links = simhash.link_fingerprints(spark.createDataFrame(rows, "fp long").repartition(2), piece=piece)
    roots = {r["node"] % 2**64: r["root"] % 2**64 for r in simhash.components(links).collect()}
    truth = brute.components(fps)
    groups = defaultdict(set)
    for f in fps:
        groups[roots.get(f, f)].add(f)
    expected = defaultdict(set)
    for f, k in zip(fps, truth):
        expected[k].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_large_buckets_are_dealt_again(spark):
    """Fingerprints that share a block: no bucket stays large, rows grow in proportion, and all near pairs meet."""
    ship_package(spark)
    rng = np.random.default_rng(9)
    shared = (rng.integers(0, 2**48, 1500, dtype=np.uint64) | np.uint64(0xABCD << 48)).tolist()
    near = [x ^ (1 << int(a)) ^ (1 << int(b)) for x in shared[:300] for a, b in [rng.choice(64, 2, replace=False)]]
    fps = sorted({*shared, *near})
    table = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long").repartition(3)
    got = defaultdict(list)
    for r in simhash.buckets(table, piece=50).collect():
        assert r["value"] == r["mask"] & r["fp"]
        got[r["mask"], r["value"]].append(r["fp"] % 2**64)
    assert max(map(len, got.values())) <= 50 and sum(map(len, got.values())) < 8 * len(fps)
    pairs = {(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3}
    met = {(a, b) for v in got.values() for a in v for b in v if a < b and (a ^ b).bit_count() <= 3}
    assert len(pairs) >= 300 and met == pairs
    assert simhash._further(-1 << 16, 4) == [-1 << 16 | 0xF << 4 * i for i in range(4)]


def test_gray_rank_orders_the_code():
    code = np.arange(1 << 10, dtype=np.uint64)
    assert (simhash.gray_rank(code ^ (code >> np.uint64(1))) == code).all()


def test_packing(docs, rows):
    encode = packing.load_encoder(public_tokenizers.path("byte_bpe_50k.json"))
    out = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), size=256).collect()
    expected = []
    for r in rows:
        ids = np.append(encode(r[1] or ""), np.uint32(1))
        expected += [(r[0], s, n, c, len(ids)) for s, n, c in packing.cut(ids, 256)]
    same_rows([tuple(r)[:5] for r in out], expected)
    filled = defaultdict(list)
    for r in out:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(filled) == set(range(len(filled)))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256


def test_encoder_equals_the_tokenizer(rows):
    from tokenizers import Tokenizer
    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    fast = packing.load_encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [r[1] or "" for r in rows if r[0] != 108]
    # Every character that the fast way takes, alone and between letters, digits and spaces.
    texts += [f"a{chr(c)}b 1{chr(c)}2 {chr(c)} \n{chr(c)}{chr(c)} x" for c in range(packing.PLAIN_BELOW)]
    for t in texts:
        assert fast(t).tolist() == slow.encode(t, add_special_tokens=False).ids, repr(t)


def test_histogram_packs_are_full():
    rng = np.random.default_rng(5)
    histogram = Counter(rng.integers(1, 2049, 50_000).tolist())
    places = packing.pack_histogram(histogram)
    used = Counter()
    for p in places:
        for s in range(p.sequence, p.sequence + p.count):
            assert used[s] == p.offset
            used[s] += p.length
    assert max(used.values()) <= 2048 and sum(used.values()) == sum(k * v for k, v in histogram.items())
    assert sum(used.values()) / (2048 * len(used)) > 0.98
    assert len(places) < 20_000


def test_contamination(spark, docs, rows):
    words = rows[108 - 100 + 60][1].split()
    items = [(1, " ".join(words[50:70])), (2, " ".join(words[55:90])), (10, "one TWO"), (11, "123"), (12, None), (13, ""), (14, "!!"),
             (None, " ".join(words[900:930])), (1, " ".join(words[50:70])), (15, rows[0][1]), (16, " ".join(brute.SPACED.findall(rows[5][1])[3:20]))]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("n_hit", F.lit(1))
    expected = [(r[0], *c) for r, c in zip(rows, brute.contamination([r[1] for r in rows], items))]
    assert len({e[-1] for e in expected}) == 2
    blocks = list(decontaminate.benchmark_blocks(benchmark, 50))
    assert len(blocks) > 3 and sum(len(b.items) for b in blocks) == len(set(items))
    for block in (8 << 20, 50):
        out = decontaminate.contamination(docs, benchmark, block_bytes=block)
        same_rows(out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect(), expected)
    longest = {r["doc_id"]: r["longest_match"] for r in out.collect()}
    # words 50 to 90 are covered by two items; the longest single match is the second item's 35 words
    assert longest[108] == 35 and longest[104] == 2 and longest[100] == 0
    assert decontaminate.clean(docs, benchmark).count() == sum(not e[-1] for e in expected)
    assert decontaminate.contamination(docs, benchmark.limit(0)).where("n_hit > 0").count() == 0


URLS = ["http://a.com/x", "https://EXAMPLE.com/en/1", "http://www.example.com/en/", "http://m.www.example.com/en/q?x=/en/", "x.example.com/en/",
        "http://shop.net/es/2", "http://shop.net/fr", "http://shop.net/fr/", "http://bad-domain.net/x", "http://sub.bad-domain.net/?q", "http://notbad-domain.net/",
        "http://xcom/", "http://com/", "ftp://org#a/b", "://", "http://", "http:///path/only", "http://u.org?x/y", "http://u.org/p;a?b#c", None, "", "a://b://c/d",
        "http://BAD-domain.NET:80/x", "http://ü.org/é", "http://bad-domain.net./"]


@pytest.mark.parametrize("n_slices", [1, 3])
def test_url_verdicts(spark, n_slices):
    ship_package(spark)
    urls = URLS + [f"http://h{i % 211}.org/p{i}" for i in range(600)] + URLS[:3]
    listed = {"bad-domain.net", "u.org", "a.com/x", "example.com/en/1", "a/", *[f"h{i}.org" for i in range(0, 211, 3)],
              *[f"h{i % 211}.org/p{i}" for i in range(0, 600, 4)]}
    listing = spark.createDataFrame([(x,) for x in [*listed, "u.org", "A.com/x", "a.com/X", "/path/only", "", None, "not-seen.org"]], "domain string")
    pages = spark.createDataFrame([(i if i else None, u, "<p>") for i, u in enumerate(urls)], "page_id long, url string, html string").withColumn("rule", F.lit("clash"))
    out = url_filter.judge(pages, listing, n_slices=n_slices)
    same_rows(out.select("page_id", "host", "path", "rule", "verdict").collect(),
              [(i if i else None, *brute.judge_url(u, listed)) for i, u in enumerate(urls)])


def test_cascade_is_exact(spark):
    ship_package(spark)
    universe = spark.range(3000).select(F.xxhash64("id").alias("h"))
    hashes = universe.toPandas()["h"].to_numpy()
    # Every seventh key is listed, as are keys that the universe does not have.
    listing = spark.range(0, 3500, 7).select(F.xxhash64("id").alias("h"))
    cascade = url_filter.build_cascade(listing, universe)
    members = np.isin(hashes, listing.toPandas()["h"].to_numpy())
    assert (url_filter.listed(hashes.view(np.uint64), cascade) == members).all()
    assert len(cascade) >= 3 and sum(f.n_bits for f in cascade) < 10 * members.sum()
    for one, expected in ((universe, True), (universe.limit(0), False)):
        assert set(url_filter.listed(hashes.view(np.uint64), url_filter.build_cascade(one, universe)).tolist()) == {expected}
    with pytest.raises(ValueError):
        url_filter.build_cascade(listing, universe, max_filter_bytes=4)


def test_block_list(spark):
    bar, prose = "a | b | c " * 20, "no list | here " + "word " * 100
    rows = [("http://x.ads-track.Com/p", prose), ("https://K.org/list?page=1", bar), ("http://k.org/none", prose), ("http://root.org", bar),
            ("none", bar), (None, bar), ("http://n.org/x", None), ("http://e.org/x", ""), ("https://k.org/list#2", bar)]
    got = block_list(spark.createDataFrame(rows, "url string, html string").withColumn("host", F.lit("clash"))).collect()
    assert sorted(r["domain"] for r in got) == ["ads-track.com", "k.org/list"]


def test_co_training(spark, docs):
    ship_package(spark)
    known = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = co_training.fit(known, labels.unionByName(labels.limit(5)))
    out = co_training.score(known, model).join(labels, "doc_id").collect()
    held = [r for r in out if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    good = [r["quality"] == 1 and r["toxic"] == 0 for r in held]
    assert np.mean([r["kept"] == g for r, g in zip(held, good)]) > max(np.mean(good), 0.8)
    assert np.mean([r["kept"] for r, g in zip(held, good) if g]) > 0.93
    toxic = "lower(text) rlike '\\\\b(trash|pathetic|idiot|disgusting|worthless|stupid|clown|loser|scum|moron)\\\\b'"
    caught = co_training.score(known.where(toxic), model).agg(F.count("*"), F.sum(F.col("kept").cast("int"))).first()
    assert caught[0] > 50 and caught[1] < 0.2 * caught[0]
    for r in co_training.score(docs, model).collect():
        assert all(0 <= r[c] <= 1 for c in ("text_score", "meta_score", "score")) and r["size"] == "clash"
        assert r["kept"] == (r["score"] >= 0.5 and bool(brute.SPACED.search(r["text"] or "")))
    bare = co_training.score(docs.select("doc_id", "text"), model)
    assert bare.columns == ["doc_id", "text", *co_training.OUT] and bare.count() == docs.count()
    none = co_training.fit(docs.select("doc_id", "text", "lang", "source", "n_chars"), labels.limit(0))
    assert none is None and co_training.score(docs, none).where("kept").count() == docs.where(r"text rlike '[^\\x20\\x09-\\x0D]'").count()


def test_co_training_evidence():
    """A word of one class only tells; a common word and a word seen once do not, and rows of weight 0 do not count."""
    rows = [np.array([1, 2] if i < 10 else [1]) for i in range(40)] + [np.array([3]), np.array([4, 5])]
    y = np.array([0.0] * 10 + [1.0] * 30 + [0.0, 1.0])
    weight = np.array([1.0] * 41 + [0.0])
    x = co_training.Sparse(rows, y, weight)
    assert x.ids.tolist() == [2] and x.n == 42
    share, n = 10 / 11, (11, 30)
    p = 10 / 41
    z = share / np.sqrt(p * (1 - p) * (1 / n[0] + 1 / n[1]))
    assert np.allclose(x.evidence, (z - co_training.MIN_EVIDENCE) / 4)
    assert np.allclose(x.dot(np.ones(1))[:11], [x.evidence[0] / np.log(np.e + 2)] * 10 + [0])
    none = co_training.Sparse([np.zeros(0, np.int64)] * 3, np.array([0.0, 1.0, 0.0]), np.ones(3))
    assert none.dims == 0 and none.dot(np.zeros(0)).tolist() == [0, 0, 0] and not none.spread_out(np.zeros(0)).any()


def view_rows(rng, n, words, bad):
    """Feature rows: words 10 to 19 are noise; the first metadata feature tells the class."""
    meta = np.zeros(co_training.N_SOURCES + co_training.N_LANGS + co_training.N_LAYOUT + 1, np.float32)
    meta[0 if bad else 1] = 1
    return [(np.unique(np.r_[words, rng.integers(10, 20, 3)]).astype(np.int32).tobytes(), meta.tobytes()) for _ in range(n)]


VIEW = "doc_id long, y int, kind int, text binary, meta binary"


def test_views_teach_each_other_over_all_rows(spark):
    """Labelled rows show words 1 and 2 only; by the metadata the text view also learns words 3 and 4 of the unlabelled ones."""
    rng = np.random.default_rng(0)
    parts = [(0, 0, view_rows(rng, 150, [1], True)), (1, 0, view_rows(rng, 150, [2], False)), (0, 1, view_rows(rng, 60, [1], True)), (1, 1, view_rows(rng, 60, [2], False)),
             (0, 2, view_rows(rng, 2500, [3], True)), (0, 2, view_rows(rng, 2500, [4], False))]
    flat = [(y, kind, *views) for y, kind, rows in parts for views in rows]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(flat)], VIEW).repartition(4)
    model = co_training.co_train(df, max_fitted=300)
    assert model.text[0][1] < 0 < model.text[0][2] and model.text[0][3] < 0 < model.text[0][4]
    untaught = co_training.co_train(df, rounds=0)
    assert untaught.text[0][3] == untaught.text[0][4] == 0
    assert co_training.co_train(df.where("kind = 2")) is None


def test_pseudo_labels_and_evidence_use_every_row(spark):
    """Against plain Python: the surest rows by quantiles over the whole pool, and word evidence over all training rows."""
    rng = np.random.default_rng(1)
    z = rng.normal(size=3000)
    df = spark.createDataFrame([(i, 2 if i % 10 else 0, float(v)) for i, v in enumerate(z)], "doc_id long, kind int, text_z double").repartition(5)
    pool = np.array([v for i, v in enumerate(z) if i % 10])
    got = {r["doc_id"]: r["y"] for r in co_training.pseudo_labels(df, "text", 0.7, 0.1).collect()}
    low, high = (np.sort(pool)[math.ceil(q * len(pool)) - 1] for q in (0.1 * (1 - 0.7), 1 - 0.1 * 0.7))
    assert got == {i: int(v >= high) for i, v in enumerate(z) if i % 10 and (v >= high or v <= low)}
    assert co_training.pseudo_labels(df.where("kind = 0"), "text", 0.7, 0.1).collect() == []
    rows = [(np.unique(rng.integers(0, 50, 8) if y else rng.integers(20, 90, 8)).astype(np.int32), y, w) for y, w in zip(rng.integers(0, 2, 400).tolist(), rng.choice([1.0, 0.5], 400).tolist())]
    evidence = co_training.counted_evidence(spark.createDataFrame([(t.tobytes(), y, w) for t, y, w in rows], "text binary, y int, weight double").repartition(3))
    count, total = np.zeros((2, co_training.DIMS)), [0.0, 0.0]
    for t, y, w in rows:
        count[y][t] += w
        total[y] += w
    assert np.allclose(evidence, co_training.word_evidence(count[0], count[1], *total)) and (evidence > 0).sum() > 20


def test_empty_tables(spark):
    ship_package(spark)
    none = empty(spark)
    benchmark = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string")
    model = co_training.fit(none, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    for out in (sharding.shard(none), line_quality.judge_lines(none), phrase_dedup.remove_repeats(none),
                token_count.count_tokens(none, public_tokenizers.path("piece_bpe_32k.model")), language.identify(none), simhash.near_duplicates(none),
                simhash.keep_first(none), packing.pack(none, public_tokenizers.path("byte_bpe_50k.json")), decontaminate.contamination(none, benchmark),
                url_filter.judge(pages, spark.createDataFrame([], "domain string")), co_training.score(none, model)):
        assert out.collect() == []
