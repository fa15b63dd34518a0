"""Small documents and rows for the tests."""

import json

DAY = 86_400_000
HOUR = 3_600_000
T0 = 1_270_080_000_000  # 2010-04-01 00:00 UTC


def feature(id, time=T0, place="1km N of A, B", mag=1.0, tsunami=0, sig=10, coordinates=(1, 2, 3)):
    return {
        "id": id,
        "properties": {
            "place": place,
            "time": time,
            "mag": mag,
            "magType": "ml",
            "tsunami": tsunami,
            "type": "tremor",
            "alert": None,
            "sig": sig,
            "net": "n",
        },
        "geometry": {"coordinates": list(coordinates)},
    }


def document(*features, count=None):
    announced = len(features) if count is None else count
    return json.dumps({"metadata": {"count": announced}, "features": list(features)})


def landing(spark, *documents):
    """Documents numbered from 1 unless given as (number, text)."""
    rows = [
        one if isinstance(one, tuple) else (i, one) for i, one in enumerate(documents, start=1)
    ]
    return spark.createDataFrame(rows, "doc_seq BIGINT, value STRING")


def rows_of(df, *columns):
    """All rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
