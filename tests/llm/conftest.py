import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text[, lang, source]) rows."""

    def docs(rows):
        full = [(i, t, *([*rest, "en", "src0"][:2]), len(t or "")) for i, t, *rest in rows]
        return spark.createDataFrame(full, SCHEMA)

    return docs


@pytest.fixture(scope="session")
def odd(spark, make):
    """Rows that must not break an operator: nulls everywhere, empty and blank texts, repeated rows, a long text, clashing names."""
    long_text = " ".join(f"word{i % 997} tail" for i in range(60_000))
    rows = [(None, None, None, None), (1, None, "en", None), (2, "", None, "src1"), (3, " \n\t ", "en", "src1"), (4, "one", "en", "src1"), (4, "one", "en", "src1"), (None, "one two three four", "en", "src2"), (5, long_text, "en", "src0"), (-6, "a b c d e\n\nf g h", "fr", "src0"), (7, "Ünïcödé \u2028 𝄞 text", "de", "srcX")]
    df = make(rows)
    for name in ("node", "key", "k1", "h", "mix_pos", "mix_slot", "set_id", "keep_doc", "cut_lines", "key_1", "score", "rank", "n"):
        df = df.selectExpr("*", f"doc_id as {name}")
    return df
