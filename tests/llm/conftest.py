import pytest

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents():
    """doc_id and text of the small table, with copies, near copies, nulls, blanks and a long text added."""
    import pyarrow.parquet as pq

    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()]
    long = " ".join(t for _, t in rows[:60])
    extra = [rows[0][1], rows[0][1], rows[1][1] + " tail", None, "", " \n\t", "...", "One. Two. Three.", "One. Two. Three.",
             "x", "x", "Ünïcödé ẞ text", long, long + " more", rows[2][1].upper()]
    return rows + [(100_000 + i, t) for i, t in enumerate(extra)]


DOC_SCHEMA = "doc_id long, text string, rid string, key int, n int, fp string, n_removed string, row int, body int"


@pytest.fixture(scope="session")
def docs_df(spark, documents):
    """The same rows with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "r", 1, 2, "f", "z", 3, 4) for i, t in documents], DOC_SCHEMA).repartition(5)
