"""Registered queries against their SQL, and the pipeline against a brute-force version of its stages."""

import hashlib
import math
import random
import string
import zlib
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from clickmart.llm import language
from clickmart.llm.oracles import ORACLE
from clickmart.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.fixtures import SCHEMA, messy_rows, same_rows
from tools.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df, res = QUERIES[name](spark, SF), con.sql(ORACLE[name])
    shared = sorted(res.columns)
    assert sorted(df.columns) == shared
    assert rows_of(shared, [tuple(r) for r in df.select(*shared).collect()]) == rows_of(shared, res.select(*shared).fetchall())


#: Languages that the driver's documents do not have.
UNKNOWN = (
    "Wczoraj wieczorem poszliśmy do kina, a potem długo rozmawialiśmy o filmie przy herbacie. Pogoda była zimna i padał deszcz, więc wróciliśmy autobusem do domu.",
    "Eilen illalla menimme elokuviin ja sen jälkeen puhuimme pitkään elokuvasta teen äärellä. Sää oli kylmä ja satoi vettä, joten palasimme bussilla kotiin.",
    "Dün akşam sinemaya gittik ve sonra çay içerken uzun uzun film hakkında konuştuk. Hava soğuktu ve yağmur yağıyordu, bu yüzden eve otobüsle döndük.",
    "Вчера вечером мы пошли в кино, а потом долго говорили о фильме за чаем. Погода была холодной, и шёл дождь, поэтому мы вернулись домой на автобусе.",
    "Ieri sera siamo andati al cinema e poi abbiamo parlato a lungo del film davanti a un tè. Il tempo era freddo e pioveva, così siamo tornati a casa in autobus.",
    "昨日の夜、私たちは映画館に行き、その後お茶を飲みながら映画について長い間話しました。天気は寒く、雨が降っていたので、バスで家に帰りました。",
    "Tegnap este moziba mentünk, aztán sokáig beszélgettünk a filmről tea mellett. Az idő hideg volt és esett az eső, ezért busszal mentünk haza.")


def test_pipeline_rejects_unknown_languages(spark):
    """Unlearned languages and letter noise go; of the held-out documents of each language nearly all stay."""
    rng = random.Random(1)
    noise = [" ".join("".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randint(2, 9))) for _ in range(60)) for _ in range(6)]
    known = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    strange = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate([*UNKNOWN, *noise])], "doc_id long, text string, lang string")
    kept = corpus_pipeline.language_id(spark, known.unionByName(strange), "").collect()
    assert not [r for r in kept if r["doc_id"] < 0]
    all_of, kept_of = (Counter(r["lang"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for rows in (known.collect(), kept))
    assert len(all_of) == 4 and all(kept_of[x] >= 0.95 * n for x, n in all_of.items())


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_pipeline_stage_of_an_empty_table(spark, name):
    """No rows; all but the last stage keep the columns."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, "/root/testdata/sf0.001")
    assert out.count() == 0 and (name == "sequence_packing" or out.columns == docs.columns)


def test_pipeline_stages(spark, tmp_path):
    """Each stage on its own input; texts, kept documents and pieces as by plain Python."""
    rows = [r for r in messy_rows() if r[0] is not None and (r[0], r[1]) != (113, messy_rows()[1][1])]
    rows = list({r[0]: r for r in rows}.values())  # one row for each id
    folder = str(tmp_path)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    items = [(1, " ".join(brute.SPACED.findall(rows[10][1])[:30])), (2, "one two"), (3, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_duplicates", "repeated_passages", "benchmark_decontamination", "sequence_packing"]
    stage = dict(corpus_pipeline.STAGES)

    known = stage["language_id"](spark, docs, folder)
    assert known.columns == docs.columns
    model = language.fit(language.training_rows(docs))
    judged = language.predict(docs, model).collect()
    held = [r for r in judged if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 and r["lang"] is not None and r["lang_pred"] != "und"]

    def least(rows):  # the smallest score that half a per cent of the rows do not exceed
        scores = sorted(r["score"] for r in rows)
        return scores[max(math.ceil(corpus_pipeline.MAX_LOSS * len(scores)), 1) - 1] if scores else 0.0

    def placed(r):
        return r["lang_pred"] != "und" and r["score"] >= max(least(held), least([x for x in held if x["lang"] == r["lang_pred"]]))
    same_rows(known.collect(), [[r[c] for c in docs.columns] for r in judged if placed(r)])
    assert {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in known.collect()} >= {100, 101, 102, 109}

    kept = sorted(map(tuple, stage["near_duplicates"](spark, docs, folder).collect()))
    ordered = sorted(rows)
    label = brute.components([brute.fingerprint(r[1]) for r in ordered])
    same_rows(kept, [r for i, r in enumerate(ordered) if label[i] == i])

    stripped = {r["doc_id"]: r for r in stage["repeated_passages"](spark, docs, folder).collect()}
    assert len(stripped) == len(rows)
    for (doc_id, text, *_), (_, removed, digest) in zip(ordered, brute.remove_repeats([(r[0], r[1]) for r in ordered])):
        got = stripped[doc_id]["text"]
        if removed:
            assert hashlib.sha256(got.encode()).hexdigest() == digest and stripped[doc_id]["n_chars"] == len(got)
        else:
            assert got == text

    clean = stage["benchmark_decontamination"](spark, docs, folder).collect()
    bad = brute.contamination([r[1] for r in rows], items)
    same_rows(clean, [r for r, b in zip(rows, bad) if not b[-1]])
    assert len(clean) < len(rows)

    packed = stage["sequence_packing"](spark, docs, folder)
    assert packed.groupBy("doc_id").sum("length").count() == len(rows)
    whole = corpus_pipeline.run(spark, folder)
    assert whole.columns == packed.columns and 0 < whole.select("doc_id").distinct().count() < len(rows)
