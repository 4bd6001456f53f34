"""Small documents with every awkward case, and the words of the contracts."""
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def documents(seed=7, n=60):
    """Rows of ``documents``: copies, near copies, shared passages, nulls in any
    column, empty and very long texts, repeated rows, odd white space."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefghéß") for _ in range(rng.randint(1, 7))) for _ in range(300)]

    def prose(k):
        out = []
        for i in range(k):
            out.append(rng.choice(vocab))
            out.append(rng.choice([" ", " ", " ", "\n", "\t", "  ", "  ", ".\n"]))
        return "".join(out)

    passage = " ".join(rng.choice(vocab) for _ in range(75))
    base = prose(160)
    rows = []
    for i in range(n):
        kind = i % 10
        if kind == 0:
            text = base
        elif kind == 1:
            w = base.split(" ")
            for _ in range(rng.randint(1, 6)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            text = " ".join(w)
        elif kind == 2:
            text = prose(rng.randint(5, 60)) + passage + " " + prose(rng.randint(5, 60))
        elif kind == 3:
            text = base.upper() if i % 20 == 3 else base.title()
        elif kind == 4:
            text = prose(rng.randint(1, 6))
        elif kind == 5:
            text = passage[:rng.randint(200, len(passage))]
        else:
            text = prose(rng.randint(10, 400))
        rows.append((i * 3 % 101, text, rng.choice(["en", "fr", None]), f"src{i % 7}" if i % 3 else "src0", len(text)))
    rows += [(500, "", "en", "src1", 0), (501, None, None, None, None), (502, " \t\n ", "en", "", 4), (None, base, None, "src2", None),
             (None, None, None, None, None), (503, "one", "en", "Src0", 3), (503, "one", "en", "Src0", 3), (504, "word " * 3000, "en", "zürich", 15000),
             (505, "x" * 20000 + " " + "y" * 20000, "en", "src0", 40001), (506, "😀 " * 200 + passage, "en", "src0", 0), (507, "a b c d", "en", "src0", 7),
             (508, "A B C D", "en", "src0", 7), (509, passage + " " + passage, "en", "src3", 0), (503, "another text of this id", "en", "src1", 1)]
    return rows


def frame(spark, rows=None, parts=4, extra=()):
    """The rows as a DataFrame; ``extra``: more columns with names that could clash."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(parts)
    for c in extra:
        df = df.withColumn(c, F.lit("clash"))
    return df
