"""Small document tables for the tests."""

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, token bigint"


def rows(spark, texts, ids=None, **more):
    """Documents with an extra column whose name clashes with those the operators use inside."""
    ids = list(range(len(texts))) if ids is None else ids
    lang, source = more.get("lang", ["en"] * len(texts)), more.get("source", ["a"] * len(texts))
    data = [(i, t, x, s, None if t is None else len(t), "clash", 1) for i, t, x, s in zip(ids, texts, lang, source)]
    return spark.createDataFrame(data, SCHEMA)
