"""A small table of documents with nulls, empty and long texts, copies, repeated rows and columns with clashing names."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, node string, score string, trusted string, task string"


def prose(rng: random.Random, n: int) -> str:
    words = ["the", "of", "and", "river", "stone", "light", "carries", "over", "under", "garden", "walks", "seven", "quiet", "people", "saw", "a", "bright", "old", "house", "near"]
    return " ".join(rng.choice(words) + (rng.choice(["", ".", ","]) if rng.random() < 0.2 else "") for _ in range(n))


def rows(seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    texts: list[tuple[int | None, str | None]] = [(k, prose(rng, rng.randint(5, 160))) for k in range(40)]
    base = prose(rng, 200)
    texts += [(100 + k, base) for k in range(4)]
    texts += [(110 + k, base.replace("river", "lake", k)) for k in range(1, 5)]
    texts += [(120, base.upper()), (121, " ".join(base.split()[:150])), (122, base), (122, base)]
    texts += [(130, None), (131, ""), (132, " \n\t"), (133, "one two"), (134, "ONE  two"), (135, "a b c d e"), (136, "ünïcode ﬁ Ω 日本 語"), (137, "x" * 50_000), (138, prose(rng, 20_000)), (None, base), (None, "no id here")]
    texts += [(140, "### &&& %%% $$$ ||| " * 80), (141, "SAME LINE\n" * 90), (142, prose(rng, 70) + ' token = "' + "0123456789abcdef" * 3 + '" ' + prose(rng, 9))]
    return [(i, t, rng.choice(["en", "fr", None]), "s", len(t) if t is not None else None, "k", "n", "s", "t", "x") for i, t in texts]


def table(spark, data: list[tuple] | None = None, partitions: int = 3):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(partitions)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
