"""Small tables with the awkward rows every corpus operator has to take."""

import random

WORDS = [a + b for a in ("th", "on", "er", "an", "re", "qu", "ti") for b in ("a", "e", "or", "ing", "s", "ent")]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def texts(seed=5):
    """(id, text): copies, near copies, shared passages and lines, nulls, blanks, a very long text."""
    rng = random.Random(seed)
    passage, line = sentence(rng, 60), sentence(rng, 20)
    plain = [sentence(rng, rng.randint(5, 120)) for _ in range(25)]
    rows = list(plain)
    rows += [plain[0], plain[0], plain[1] + " ther", "start " + plain[2]]
    rows += [f"{sentence(rng, 15)} {passage} {sentence(rng, 15)}" for _ in range(4)]
    rows += [f"{passage} {passage}", f"{sentence(rng, 8)}\n{line}\nshort\n{line}\n{sentence(rng, 9)}", f"{line}\nshort\n{sentence(rng, 7)}"]
    rows += ["\n".join([line, "a", "b", line, "a", "b"]), "de " * 300, sentence(rng, 30_000)]
    rows += [None, "", "   \n\t ", "123 456", "É è\u00a0ß 語", "A\x0bB\x0cC\rD"]
    numbered = list(enumerate(rows, 10))
    rng.shuffle(numbered)
    return [*numbered, (None, plain[3]), (None, None), numbered[0], numbered[0], (-5, plain[4])]


def documents(spark, rows=None, **extra):
    """The rows with columns whose names operators also use for themselves."""
    named = [(*r, "x", 1, 2.0, "y") for r in (texts() if rows is None else rows)]
    return spark.createDataFrame(named, "doc_id bigint, text string, fingerprint string, n_words bigint, score double, chunk string")
