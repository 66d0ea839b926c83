"""Small messy inputs, and the rules of the operators said plainly."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, component_id long"


def sentence(rng, words):
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()) + str(rng.randint(0, 30)) for _ in range(words))


def rows(seed=3, many=40):
    """Copies, near copies, shared lines, ties, nulls, empty and one very long text."""
    rng = random.Random(seed)
    base = [sentence(rng, rng.randint(20, 90)) for _ in range(12)]
    texts = [None, "", " \n\t", "one", "one two", "Ünïcode ä", "a\x1cb c", base[0].upper(), "\n".join(base[:3])]
    for k in range(many):
        words = base[k % 12].split()
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            words[rng.randrange(len(words))] = "changed" + str(rng.randint(0, 9))
        texts.append(" ".join(words) + rng.choice(["", "\nA shared line of some length", "\n  a SHARED line of some length \nshort"]))
    texts.append(sentence(rng, 30_000))
    out = [(i * 3 % 101, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    out += [out[12], out[12]]  # repeated rows
    return out


def docs(spark, made=None):
    made = rows() if made is None else made
    return spark.createDataFrame([(*r, None, 7) for r in made], SCHEMA)


def with_nulls(made):
    return [*made, (None, "lonely text without an id", "en", None, 3), (None, made[10 % len(made)][1], None, "s1", None)]
