"""Frames that every operator has to bear: nulls, empty and very long texts, ties, repeated rows, clashing names."""

from tablewright.session import small_frame

LONG = " ".join(f"word{i} number{i % 7}" for i in range(20_000)) + "x" * 5000
TEXTS = [(1, None), (2, ""), (3, "   \n\t "), (4, LONG), (5, "The cat sat on the mat and looked at the old dog."),
         (6, "The cat sat on the mat and looked at the old dog."), (6, "The cat sat on the mat and looked at the old dog."),
         (None, "No id here, but the cat sat on the mat."), (7, "…!!! 12345 ???"), (8, "Ünïcödé \U0001F600 text\u0000 with odd\u2028marks"),
         (9, "a"), (10, "two words")]
# names that operators use for their own columns
EXTRA = "score double, component_id long, key string, n long, ids string, part int, block string, rule string, u double, y int, id long"


def edge_docs(spark, texts=TEXTS):
    rows = [(i, t, None if k % 4 == 0 else "en", None if k % 3 == 0 else f"s{k % 2}", None if t is None else len(t),
             0.5, 7, "k", 1, "x", 3, "b", "r", 0.1, 1, 99) for k, (i, t) in enumerate(texts)]
    return small_frame(spark, rows, "doc_id long, text string, lang string, source string, n_chars long, " + EXTRA)


def none_of(spark):
    return edge_docs(spark, TEXTS[:1]).limit(0)
