"""Schemas of the records that sources and sinks exchange."""

from pyspark.sql import types as T

_S, _TS = T.StringType(), T.TimestampType()


def _of(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


RAW_DOC = _of(u=_S, t=_S, d=_S, c=_S, l=_S, s=_S)
CRAWLED_DOC = _of(u=_S, t=_S, d=_S, c=_S, k=_S, text=_S, canonical=_S, image=_S, lang=_S, links=T.ArrayType(_S), status=T.IntegerType(), content_type=_S, fetched_at=_TS, src=_S)
SEED_DOC = _of(u=_S, t=_S, d=_S, c=_S, src=_S, log=_S, ts=_TS)
MENTION = _of(u=_S, src=_S, host=_S, tone=T.DoubleType())
SIGNALS = _of(u=_S, tech=T.ArrayType(_of(item=_S, count=T.LongType())), perf=T.DoubleType(), seo=T.DoubleType(), https=T.BooleanType(), mobile=T.BooleanType())
LOG_LIST = _of(operators=T.ArrayType(_of(name=_S, logs=T.ArrayType(_of(description=_S, url=_S, state=_of(usable=_of(timestamp=_S), qualified=_of(timestamp=_S)))))))
WARC_RECORD = _of(uri=_S, body=T.BinaryType())
