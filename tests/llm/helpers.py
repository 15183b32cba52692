"""Small inputs that every operator must take."""

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Extra columns named like the operators' own.
CLASHING = ("key long, norm string, row string, node long, component string, ids string, spans string, kept string, fold string, "
            "_near_id long, n long, n_points long, keep_id long, class long, band long, mark long, pair long, links long")

random.seed(11)
WORDS = ["".join(random.choice("aeioulnrst") for _ in range(random.randint(2, 8))) for _ in range(400)]


def sentence(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def odd_rows():
    long = sentence(60_000, 5)
    near = sentence(200, 6)
    return [
        (1, sentence(80, 1), "en", "a", 1),
        (2, sentence(80, 1), "en", "a", 1),                      # copy
        (2, sentence(80, 1), "en", "a", 1),                      # repeated row
        (3, None, "en", "a", None),                              # null text
        (4, "", None, None, 0),                                  # empty text
        (5, " \t\n\r", "en", "a", 4),                            # white space only
        (6, long, "en", "b", len(long)),                         # very long
        (7, "x" * 50_000, "en", "b", 50_000),                    # one long word
        (8, near, "en", "b", 1),
        (9, near + " tail", "en", "b", 1),                       # near copy
        (None, sentence(80, 1), "en", "a", 1),                   # null id
        (10, "one two three", "de", "a", 3),                     # fewer than five words
        (11, "ONE two\tthree", "de", "a", 3),
        (12, "äöü é \U0001f600 ſK token: \U0001f600", "de", "a", 5),
    ]


def odd_docs(spark, rows=None):
    rows = odd_rows() if rows is None else rows
    df = spark.createDataFrame(rows, DOC_SCHEMA)
    return df.selectExpr("*", *[f"CAST(NULL AS {c.split()[1]}) AS {c.split()[0]}" for c in CLASHING.split(", ")])


def no_docs(spark):
    return odd_docs(spark, [])


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}
