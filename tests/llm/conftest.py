import pytest

#: Columns whose names operators use themselves.
CLASHES = "id long, node long, token long, n int, v string, counts string, kept string, rule string, copies string, target string, size string, block string, bucket string, shard string, print string, pos int, deleted string, rank int, blob string, spans string, score string, component string, s string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, source]) rows, with columns of clashing names if asked for."""

    def make(rows, clashes=False):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1]) if r[1] else 0) for r in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
        if clashes:
            for part in CLASHES.split(", "):
                name, kind = part.split(" ")
                df = df.selectExpr("*", f"cast(7 as {kind}) as {name}")
        return df

    return make
