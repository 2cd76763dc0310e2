import pytest

SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table from (doc_id, text, lang, source) rows; missing fields are null."""
    return lambda rows: spark.createDataFrame([tuple(r) + (None,) * (4 - len(r)) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def generated():
    """Deterministic prose: words of syllables, with exact and near copies, and odd texts."""
    import random

    rng = random.Random(5)
    syllables = ["ka", "to", "mi", "re", "shu", "an", "el", "or"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))

    def text(n):
        return " ".join(word() + rng.choice(["", "", "", ".", ","]) for _ in range(n))

    texts = []
    for i in range(150):
        kind = i % 10
        if kind < 6 or not texts:
            texts.append(text(rng.randint(1, 120)))
        elif kind == 6:
            texts.append((rng.choice(texts) or "").replace(" ", "\n", 1))
        elif kind == 7:
            words = rng.choice([t for t in texts if t and t.split()]).split()
            for _ in range(max(1, len(words) // 25)):
                words[rng.randrange(len(words))] = word()
            texts.append(" ".join(words))
        elif kind == 8:
            texts.append(rng.choice(["", "  ", None, "é", "\t\n", "A a", "Σίσυφος 漢字"]))
        else:
            texts.append(rng.choice(texts))
    return [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", "b", "b", None, "c"])) for i, t in enumerate(texts)]
