"""Documents with everything that can be odd about them."""

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _row string, size string, digest string, fp string, part string"


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def odd_documents():
    """Null and repeated ids, null and empty texts, repeated rows, one long text, null labels and sources."""
    rng = random.Random(1)
    rows = [
        (1, None, "en", "s1"),
        (2, "", None, "s1"),
        (3, " \t\n", "en", None),
        (4, "one two three four five", "en", "s2"),
        (4, "one two three four five", "en", "s2"),
        (4, "another text with this id", "fr", "s2"),
        (None, "no id here at all", "en", "s3"),
        (None, "no id here at all", "en", "s3"),
        (7, "ONE two three four five", "en", "s2"),
        (8, prose(rng, 6000), "en", None),
        (9, "x" * 5000, None, "s1"),
        (10, "naïve café — 東京 🙂", "fr", "s1"),
        (-5, "42 1 2 3", "en", "s2"),
    ]
    rows += [(20 + k, prose(rng, rng.randint(1, 40)), rng.choice(["en", "fr"]), f"s{k % 4}") for k in range(30)]
    rows += [(60 + k, "the same words in every one of these", "en", "s1") for k in range(12)]
    return [(i, t, lang, s, len(t or ""), "clash", "clash", "clash", "clash", "clash") for i, t, lang, s in rows]


def odd_frame(spark, rows=None, parts=3):
    rows = odd_documents() if rows is None else rows
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)
