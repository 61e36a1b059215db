import pytest

from gradeloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def values(spark):
    """Evaluate a column expression over a list of inputs."""

    def run(make, inputs, kind="string"):
        width = len(inputs[0]) if isinstance(inputs[0], tuple) else 1
        rows = [i if isinstance(i, tuple) else (i,) for i in inputs]
        names = ["a", "b", "c", "d", "e"][:width]
        df = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "n int, " + ", ".join(f"{c} {kind}" for c in names))
        return [r[0] for r in df.select(make(*names).alias("v"), "n").orderBy("n").collect()]

    return run
