"""A small messy table: nulls in every column, empty and long texts, ties, repeated rows, odd characters."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names clash with outputs of the operators.
CLASHING = ("size", "shard", "slot", "kept", "score", "n_words", "text_kept", "kept_text", "lang_pred", "held_out", "items", "rule", "host", "r_doc", "r_host")


def prose(rng, n, vocabulary):
    words = [rng.choice(vocabulary) for _ in range(n)]
    return "".join(w + rng.choice([" ", " ", " ", " ", "\n", ". "]) for w in words).strip()


def messy_rows(seed=7, n=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeionrst") for _ in range(rng.randint(1, 9))) for _ in range(400)] + ["Über", "été", "naïve", "日本", "niño"]
    passage = prose(rng, 60, vocabulary)
    rows = []
    for i in range(n):
        text = prose(rng, rng.randint(3, 150), vocabulary)
        if i % 5 == 0:
            text += "\n" + passage + "\n" + prose(rng, 15, vocabulary)
        if i % 7 == 0:
            text = passage[:len(passage) // 2] + " " + text
        rows.append((i, text, rng.choice(["en", "de", "fr", None]), rng.choice(["s0", "s0", "s1", None]), len(text)))
    words = rows[1][1].split()
    rows += [
        (100, None, None, None, None), (101, "", "en", "s0", 0), (102, " \t\n\x0b\x0c\r ", "en", "s0", 7), (103, "!!! ??? -- 123", "en", "s1", 14),
        (104, "one two", "en", "s0", 7), (105, "a  b\t\tc \r\nd", "en", "s0", 11), (106, "<s> x </s> <|endoftext|> y <unk>", "en", "s0", 30),
        (107, "日本語のテキスト、全部。 ﬁ ① ẞ İ \u0085 x\u00a0y \u2581z \u3000w 🙂🙂", "ja", "s1", 40),
        (108, prose(rng, 30_000, vocabulary), "en", "s0", None), (109, "#*$%&|<> " * 30, "en", "s0", 270),
        (110, "same line here now\n" * 12, "en", "s0", 200), (111, passage + " " + passage, "en", "s1", 1),
        (112, " ".join(words + ["changed"] + words), "en", "s1", 1), (113, " ".join(words[:-1] + ["x"]), "en", "s0", 1),
        (113, rows[1][1], "en", "s0", 1), (rows[2][0], rows[2][1], rows[2][2], rows[2][3], rows[2][4]),
        (None, rows[3][1], "en", "s0", 5), (None, rows[3][1], "en", "s0", 5), (None, "no id " + rows[4][1], None, None, None), (None, None, None, None, None)]
    rows += [(200 + i, rows[6][1], "en", "s0", 9) for i in range(30)]  # a third of the rows are one text
    rows += [(300 + i, "boiler plate line of this host\n" + prose(rng, 12 + i, vocabulary), "de", "s1", 9) for i in range(25)]
    # Half of it a frequent line, and twice in the table.
    rows += [(400, "boiler plate line of this host\n" * 3 + prose(rng, 20, vocabulary), "de", "s1", 9)] * 2
    return rows


def messy(spark, clash=True):
    df = spark.createDataFrame(messy_rows(), SCHEMA).repartition(3)
    if clash:
        from pyspark.sql import functions as F
        for c in CLASHING:
            df = df.withColumn(c, F.lit("clash"))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sort_key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def same_rows(got, expected):
    got, expected = (sorted((tuple(r) for r in rows), key=sort_key) for rows in (got, expected))
    assert len(got) == len(expected)
    bad = [(g, e) for g, e in zip(got, expected) if g != e]
    assert not bad, bad[:3]
