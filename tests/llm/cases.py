"""Small tables with the awkward rows that every operator must take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, shard string, _n string, hash string, token string, comp string"


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}{'.' if i % 9 == 8 else ''}" + ("\n" if i % 37 == 36 else "") for i in range(n)).replace("\n ", "\n")


def row(doc_id, text, lang="en", source="s1"):
    return (doc_id, text, lang, source, None if text is None else len(text), "clash", "clash", "clash", "clash", "clash", "clash")


def awkward_rows():
    base = prose(1, 120)
    words = base.split(" ")
    near = " ".join(words[:60] + ["changed"] + words[61:])
    rows = [row(1, None), row(2, ""), row(3, " \n\t "), row(4, "one"), row(5, "One  two\tthree"), row(6, base), row(7, base), row(8, near),
            row(8, near), row(9, base.upper()), row(None, prose(2, 80)), row(None, None, None, None), row(10, prose(3, 50), None, None),
            row(11, "x" * 200_000, "de", "s2"), row(12, prose(4, 9000), "de", "s2"), row(13, "è漢😀 " * 30, "fr", "s3"),
            row(14, prose(5, 40) + " " + base), row(15, base + " " + prose(6, 40)), row(-5, "neg ative " * 15, "es", "s0"), row(16, prose(2, 80))]
    rows += [row(100 + i, prose(100 + i, 30 + i), ["en", "de", "fr"][i % 3], f"s{i % 4}") for i in range(40)]
    rows += [row(200 + i, base, "en", "s1") for i in range(30)]
    return rows


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(5)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
