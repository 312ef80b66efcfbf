import pytest

from quayside.llm.workers import importable


@pytest.fixture(scope="session", autouse=True)
def workers(spark, tmp_path_factory):
    """A shared folder for this run, and the package in the workers."""
    importable(spark)
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
    # the tables are small: a few tasks each
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.fixture(scope="session")
def docs_of(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"

    def make(rows):
        """Rows of (doc_id, text), or (doc_id, text, source)."""
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, schema)

    return make


def words(rng, n, kinds=400):
    return " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))
