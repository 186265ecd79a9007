import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    """A documents table from (doc_id, text[, source]) tuples."""
    def make(rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOC).repartition(parts)
    return make


@pytest.fixture(scope="session")
def sql_rows():
    """Rows of a SQL text over frames given as tables, columns by name."""
    def run(sql, **frames):
        import duckdb
        con = duckdb.connect()
        for name, frame in frames.items():
            con.register(name, frame.toArrow())
        df = con.execute(sql)
        names = [c[0] for c in df.description]
        by = sorted(range(len(names)), key=names.__getitem__)
        return [tuple(r[i] for i in by) for r in df.fetchall()]
    return run
