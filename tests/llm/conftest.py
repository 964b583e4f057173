import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use inside, as extra columns of the input.
CLASH = "row string, size string, __row string, __keep string, __slot string, digest string, key string, n string, id string, root string, fingerprint string, score string, slot string"


@pytest.fixture
def docs_of(spark, tmp_path):
    """A documents table, as a stable file scan, with extra columns of clashing names."""

    def make(rows, clash=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) + (("x",) * 13 if clash else ()) for r in rows]
        path = str(tmp_path / f"docs{len(list(tmp_path.iterdir()))}.parquet")
        spark.createDataFrame(full, DOCS + (", " + CLASH if clash else "")).coalesce(2).write.parquet(path)
        return spark.read.parquet(path)

    return make


@pytest.fixture
def hard_rows():
    """Nulls in any column, empty and long texts, ties, repeated rows."""
    long = " ".join(f"word{i % 997} run{i % 13}." for i in range(30_000))
    return [
        (1, "The quick brown fox jumps over the lazy dog."), (2, "the QUICK brown fox jumps over the lazy dog."),
        (3, None), (4, ""), (5, " \n\t "), (None, "no id at all"), (None, None), (7, "tie", None), (7, "tie", None), (8, "tie", "b"),
        (9, long, "a"), (10, "É accents ß İ Σ", None),
    ]
