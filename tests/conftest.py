import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "tidemark-tests",
        4,
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.shuffle.partitions": "2",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def ordered_stream(spark, tmp_path):
    """A stream over given batches of rows: one file, and one micro-batch, per batch."""

    def make(batches, schema):
        folder = tmp_path / f"in{len(list(tmp_path.iterdir()))}"
        folder.mkdir()
        for i, rows in enumerate(batches):
            part = folder / f"part{i}"
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(part))
            (file,) = part.glob("*.parquet")
            target = folder / f"{i:05d}.parquet"
            target.write_bytes(file.read_bytes())
            os.utime(target, (1_700_000_000 + i, 1_700_000_000 + i))
        return (
            spark.readStream.schema(schema)
            .option("maxFilesPerTrigger", 1)
            .option("pathGlobFilter", "0*.parquet")
            .parquet(str(folder))
        )

    return make


def rows_of(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
