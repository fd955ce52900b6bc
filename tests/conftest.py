import pathlib
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Raw table from headers and rows of text, numbered in one file."""

    def make(headers, rows, path="f", sheet="Sheet1", first=1):
        names = [*headers, "_path", "_sheet", "_sheet_no", "_row_no"]
        data = [(*r, path, sheet, 1, first + i) for i, r in enumerate(rows)]
        kinds = ["string"] * len(headers) + ["string", "string", "int", "bigint"]
        schema = ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds))
        return spark.createDataFrame(data, schema)

    return make


@pytest.fixture
def grid(spark):
    """Grid from {(path, sheet): rows of cells}; rows numbered from 0."""
    from tallyloom.sources.grids import GRID_SCHEMA

    def make(sheets):
        data, numbers = [], {}
        for (path, sheet), rows in sheets.items():
            numbers[path] = numbers.get(path, 0) + 1
            data += [
                ("drop", path, sheet, numbers[path], i, list(cells)) for i, cells in enumerate(rows)
            ]
        return spark.createDataFrame(data, GRID_SCHEMA)

    return make


class Rows(list):
    """Rows without a meaning in their order."""

    def __eq__(self, other):
        return sorted(self, key=repr) == sorted(other, key=repr)

    __hash__ = None


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return Rows(tuple(r) for r in picked.collect())


@pytest.fixture
def facts(spark):
    """Fact frame from dicts; `n` is the place in order."""
    import datetime as dt

    from tallyloom.schema import FACT_SCHEMA
    from pyspark.sql import types as T

    schema = T.StructType([*FACT_SCHEMA.fields, T.StructField("n", T.LongType())])

    def make(*items):
        data = []
        for i, item in enumerate(items):
            row = {f.name: None for f in FACT_SCHEMA}
            row.update(item)
            for c in ("Date", "Date_Added", "Date_Modified"):
                if isinstance(row[c], str):
                    row[c] = dt.date.fromisoformat(row[c])
            data.append((*[row[f.name] for f in FACT_SCHEMA], i))
        return spark.createDataFrame(data, schema)

    return make
