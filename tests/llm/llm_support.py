import os
import random
import re
import sys
from collections import Counter, defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, id long, version long, line string, h long"


def words(text, fold=True):
    found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in found] if fold else found


def frame(spark, texts):
    """Documents with extra columns whose names clash with internal ones."""
    rows = [(i, t, "en", s, None, "x", 1, 2, "y", 3) for i, t, s in texts]
    return spark.createDataFrame(rows, SCHEMA)


def corpus(seed=0, n=120):
    """Nulls, empty and long texts, repeated rows, shared lines and passages, near copies."""
    r = random.Random(seed)
    vocab = [f"wé{i}" for i in range(300)]
    pool = [" ".join(r.choices(vocab, k=60)) for _ in range(6)]
    lines = ["Shared  Line of some words", "tiny", " \tshared line of some words", ""]
    out = [(0, None, "a"), (1, "", None), (2, "one two", "a"), (3, " ".join(r.choices(vocab, k=8000)), "b"), (None, "no id here at all", "a")]
    for i in range(4, n):
        parts = [" ".join(r.choices(vocab, k=r.randint(1, 80)))]
        if r.random() < 0.4:
            parts.append(r.choice(pool))
        if r.random() < 0.4:
            parts.append(r.choice(lines))
        out.append((i, "\n".join(parts), r.choice("ab")))
    long = [w for w in " ".join(r.choices(vocab, k=120)).split()]
    for i in range(n, n + 20):
        copy = list(long)
        for _ in range(r.randint(0, 5)):
            copy[r.randrange(120)] = "new" + str(r.random())
        out.append((i, " ".join(copy), "a"))
    return out + [out[-1], out[10]]


__all__ = ["SCHEMA", "SF", "Counter", "corpus", "defaultdict", "frame", "random", "re", "words"]
