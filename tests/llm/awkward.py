"""Documents with every awkward case, and brute-force helpers."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names that operators add or work with
    "size int, Score double, row string, shard string, n_lines string, _id string, copies string, found string, "
    "passages string, slot string, target string, component_id string, _doc string, bytes string, evidence string"
)
EXTRA = 15
VOCABULARY = [a + b for a in "ba de fi go lu mi no ra sa tu".split() for b in "ba de fi go lu mi no ra sa tu".split()]


def sentence(rng: random.Random, words: int = 9) -> str:
    return " ".join(rng.choice(VOCABULARY) for _ in range(words)).capitalize() + "."


def prose(rng: random.Random, sentences: int, per_line: int = 3) -> str:
    lines = []
    for start in range(0, sentences, per_line):
        lines.append(" ".join(sentence(rng) for _ in range(min(per_line, sentences - start))))
    return "\n".join(lines)


def texts() -> list[str | None]:
    rng = random.Random(7)
    base = prose(rng, 30)
    words = base.split(" ")
    near = " ".join(words[:100] + ["changed"] + words[101:])
    shared = "A line that a good many documents have in common."
    out: list[str | None] = [None, "", " ", "\n", "\n\n", "one", "two words", "Two  WORDS", "été · 日本 🙂 ä", "a" * 5000]
    out += [base, base, base.upper(), near, base + "\n" + shared, shared, shared + "\n" + prose(rng, 4), "  " + shared.upper() + "\t\n" + prose(rng, 5)]
    out += ["\n".join([shared] * 3), prose(rng, 2000), " ".join(rng.choice(VOCABULARY) for _ in range(20_000))]
    passage = prose(rng, 7, 7)
    out += [prose(rng, 6) + "\n" + passage + "\n" + prose(rng, 6) for _ in range(3)]
    out += [prose(rng, rng.randint(1, 12)) for _ in range(20)]
    return out


def rows() -> list[tuple]:
    found = []
    for at, text in enumerate(texts()):
        source = [None, "a", "b", "ä", "zz"][at % 5]
        found.append((at * 3, text, "en" if at % 4 else None, source, len(text) if text else None, *[None] * EXTRA))
    found.append(found[10])
    found.append(found[16])
    found.append((None, found[10][1], None, None, None, *[None] * EXTRA))
    found.append((None, None, None, None, None, *[None] * EXTRA))
    return found


def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def none(spark):
    return spark.createDataFrame([], SCHEMA)
