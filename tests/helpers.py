import json
from datetime import datetime

from newsboard.sources import schemas as S

NOW = datetime(2020, 3, 18, 12)


def ts(text):
    return datetime.fromisoformat(text)


def rows(df, *cols):
    """Rows as tuples, sorted with NULLs last."""
    out = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(out, key=lambda r: tuple((x is None, repr(x)) for x in r))


def entry_rows(spark, docs, created=NOW):
    """Entry rows from a list of payload dicts (or (payload, created_at) pairs)."""
    data = []
    for i, doc in enumerate(docs):
        doc, at = doc if isinstance(doc, tuple) else (doc, created)
        data.append((i, at, at, at, doc.get("id", f"e{i}"), json.dumps(doc)))
    return spark.createDataFrame(data, S.ENTRIES)


def analysis_rows(spark, docs):
    """Analysis rows from {feedly_id: payload dict}."""
    data = [(NOW, NOW, k, json.dumps(v) if v is not None else None, 200, NOW, NOW) for k, v in docs.items()]
    return spark.createDataFrame(data, S.ANALYSES)


def plan_of(df):
    return df._jdf.queryExecution().toString()
