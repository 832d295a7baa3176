"""A small corpus with copies, near copies, nulls, empty and long texts, and columns whose names clash."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double, gone int, n_words string, signature string, kind int, at string"


def words(rng, n):
    return ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5))) for _ in range(n)]


def texts(seed=1):
    rng = random.Random(seed)
    passage = " ".join(words(rng, 60))
    lines = "\n".join(" ".join(words(rng, 8)) for _ in range(14))
    base = [" ".join(words(rng, rng.randint(1, 120))) for _ in range(30)]
    out = list(base)
    out += [base[3], base[3], base[5].upper(), base[5] + " tail"]
    near = base[7].split() + words(rng, 60)
    for k in range(12):
        w = list(near)
        w[rng.randrange(len(w))] = "edit"
        out.append(" ".join(w))
    out += [f"{' '.join(words(rng, k))} {passage} {' '.join(words(rng, 9))}" for k in (0, 5, 17, 30)]
    out += [f"{a}\n{lines}\n{b}" for a, b in (("one", "end"), ("two\nmore", "x"), ("three", "y z"))]
    out += [" ".join(["same"] * 90), "ab " * 200, "x" * 450, "\t \n ", "", "word", "é" * 130, " ".join(words(rng, 6000)), passage + "\n" + passage]
    return out


def rows():
    out = [(i * 3, t, "en", f"s{i % 4}" if i % 9 else None, len(t), None, 1.0, 2, "x", "y", 3, "z") for i, t in enumerate(texts())]
    out.append((7, None, None, None, None, True, None, None, None, None, None, None))
    out.append((None, "a text that has no id but some words in it", "en", "s1", 5, True, None, None, None, None, None, None))
    out.append(out[4])  # a repeated row
    return out


def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    """Rows by id; a repeated row must give equal rows."""
    out = {}
    for r in df.collect():
        assert out.setdefault(r["doc_id"], r) == r
    return out
