"""Small tables with everything that goes wrong: nulls, repeats, clashing columns, odd texts."""

from __future__ import annotations

import random
import zlib

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators might use for columns of their own.
CLASHES = ("n", "score", "copies", "fp", "_part", "size", "target", "ids", "train", "label", "start", "frame", "key")


def fold(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % 5


def odd_documents() -> list[tuple]:
    rng = random.Random(7)
    words = {
        "en": "the of and ring ation ther heed with from this that edge".split(),
        "de": "der die und ung keit ein nicht schön über lich".split(),
    }
    rows = []
    for i in range(120):
        lang = "en" if i % 3 else "de"
        text = " ".join(rng.choice(words[lang]) + rng.choice(["", "", "s", ".", "er"]) for _ in range(rng.randint(3, 40)))
        if i % 7 == 0 and lang == "en":
            text += ". you stupid scum moron idiot."
        rows.append((i, text, lang, f"src{i % 4}", len(text)))
    hot = "one text that a third of all documents share with each other word for word"
    rows += [(200 + i, hot, "en", "hot", len(hot)) for i in range(60)]
    long = " ".join(rng.choice(words["en"]) + str(rng.randrange(50)) for _ in range(20_000))
    rows += [
        (300, None, None, None, None),
        (301, "", "en", "src1", 0),
        (302, " \t\n\x0b\x0c\r ", "de", None, 7),
        (303, "!!! ... 12 34", "en", "src2", 13),
        (304, long, "en", "src3", len(long)),
        (305, "word", None, "", 4),
        (306, "a  b   c \n d e f\x1cg <|endoftext|> h", "en", "src0", 30),
        (307, "Ünï cödé \U0001f600 日本語 İI", "de", "src\U0001f600", 20),
        (None, "text without an id", "en", "src0", 18),
        (None, None, None, "src0", None),
        (5, rows[5][1], rows[5][2], rows[5][3], rows[5][4]),
        (6, "another text under the id six", "en", "src1", 29),
    ]
    return rows


def documents(spark, rows=None, clashing=False):
    df = spark.createDataFrame(odd_documents() if rows is None else rows, DOC_SCHEMA).repartition(3)
    if clashing:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("x") for c in CLASHES})
    return df


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
