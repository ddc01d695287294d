"""Small documents with the awkward cases, and plain versions of the definitions."""

from __future__ import annotations

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use inside or return
    T.StructField("_g", T.StringType()), T.StructField("piece", T.IntegerType()), T.StructField("size", T.LongType()),
    T.StructField("shard", T.StringType()), T.StructField("b", T.StringType()), T.StructField("kept", T.StringType())])

UPPER_TO_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words(text: str | None, lower: bool = False) -> list[bytes]:
    raw = (text or "").encode()
    return (raw.translate(UPPER_TO_LOWER) if lower else raw).split()


def texts(seed: int = 5) -> list[tuple[int | None, str | None]]:
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["der", "Straße", "éé", "日本", "x" * 300]

    def prose(n: int) -> list[str]:
        return [r.choice(vocab) for _ in range(n)]

    passage, out = prose(60), []
    for _ in range(40):
        body = prose(r.randint(20, 90))
        if r.random() < 0.5:
            at = r.randint(0, len(body))
            body[at:at] = passage
        out.append(" ".join(body))
    base = prose(120)
    for i in range(25):                          # near copies of one text
        own = list(base)
        for _ in range(i % 4):
            own[r.randrange(len(own))] = f"n{r.random()}"
        out.append("\n".join([" ".join(own[:60]), " ".join(own[60:])]))
    out += [out[3]] * 6 + [out[45].upper()] * 2  # exact copies; one in capitals
    out += [None, None, "", "   \n\t ", "one", "One", "two words", "TWO  words", "a b c d", "a b c d e",
            "same same same same same same same same same same same same same same same same", "x\x0by\x0cz\x1cq r",
            "# $ % & | < > *", "line\nline\nline\nother line\n\n\n", " ".join(prose(4000)), "y" * 20000,
            "\x00 nul\x00 here", "<|endoftext|> in text", "tail  ", "  head"]
    rows = list(enumerate(out, start=3))
    r.shuffle(rows)
    return rows + [rows[0], rows[1], (None, "no id here but some words of its own"), (None, out[3]), (10 ** 15, out[3])]


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None, "g", 1, 2, "sh", None, "k") for i, t in rows], SCHEMA).repartition(5)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
