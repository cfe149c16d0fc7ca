"""Builders for small bronze inputs."""

import base64
import json
from datetime import datetime, timezone

from rivulet.schemas import BRONZE, TOPIC

T0 = datetime(2024, 1, 31, 5, tzinfo=timezone.utc)


def envelope(content, path="/in/a.xml"):
    if isinstance(content, str):
        content = content.encode()
    return json.dumps(
        {
            "path": path,
            "modificationTime": "2024-01-31T05:00:00.000Z",
            "length": len(content),
            "content": base64.b64encode(content).decode(),
        }
    )


def message(value, offset=0, key="/in/a.xml", partition=0, sent="2024-01-31 05:00:00"):
    return (key, value, "transactions", str(partition), str(offset), sent, "0")


def topic(spark, messages):
    return spark.createDataFrame(messages, TOPIC)


def bronze(spark, messages, at=T0):
    rows = [(*m, at, at.date(), f"{at.hour:02d}") for m in messages]
    return spark.createDataFrame(rows, BRONZE)


def documents(spark, *texts, at=T0):
    """One message per document text, offsets in order."""
    return bronze(spark, [message(envelope(x), i, key=f"/in/{i}.xml") for i, x in enumerate(texts)], at)
