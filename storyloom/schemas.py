"""Explicit schema of every stored table, and the column contract checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRING, LONG, INT, DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
NAIVE, INSTANT = T.TimestampNTZType(), T.TimestampType()
STRINGS, TOKEN_LISTS = T.ArrayType(STRING), T.ArrayType(T.ArrayType(STRING))
VECTOR, VECTORS_LIST = T.ArrayType(DOUBLE), T.ArrayType(T.ArrayType(DOUBLE))


def _table(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


RAW_ARTICLES = _table(
    id=STRING, published=NAIVE, title=STRING, content=STRING, created_at=INSTANT,
)
ARTICLES = _table(
    source_article_id=STRING, sentence_tokens=TOKEN_LISTS, sentence_counts=INT, title=STRING, text=STRING,
    date=NAIVE, created_at=INSTANT,
)
CHUNKS = _table(
    chunk_id=LONG, source_article_id=STRING, sent_idx=INT, text=STRING,
)
VECTORS = _table(
    chunk_id=LONG, embedding=VECTOR, source_article_id=STRING, text=STRING,
)
CLUSTERS = _table(
    cluster_id=LONG, cluster_center=VECTOR, cluster_size=LONG, keywords=STRINGS, date_range_start=NAIVE,
    date_range_end=NAIVE, status=STRING, similarity_threshold=DOUBLE, last_updated=INSTANT,
)
ARTICLE_CLUSTERS = _table(
    source_article_id=STRING, cluster_id=LONG, similarity_score=DOUBLE, assignment_type=STRING,
)
QUARANTINE = _table(
    id=STRING, error=STRING, failed_at=INSTANT,
)

# Engine tables
SENTENCES = _table(
    id=STRING, date=NAIVE, sent_idx=INT, sentence=STRING, tokens=STRINGS,
)
SENTENCE_TF = _table(
    id=STRING, sent_idx=INT, term=STRING, tf=LONG,
)
ARTICLE_TF = _table(
    id=STRING, term=STRING, tf=LONG,
)
SENTENCE_VECTORS = _table(
    id=STRING, sent_idx=INT, embedding=VECTOR,
)
WINDOW = _table(
    id=STRING, date=NAIVE, slide_id=INT, embedding=VECTOR, cluster=LONG, sim=DOUBLE,
)
CENTERS = _table(
    cluster_id=LONG, center=VECTOR,
)
EMB_STATE = _table(
    cluster_id=LONG, date=NAIVE, emb_sum=VECTOR, n=LONG,
)
TF_STATE = _table(
    cluster_id=LONG, date=NAIVE, term=STRING, tf=DOUBLE,
)
THEME = _table(
    cluster_id=LONG, rank=INT, term=STRING, score=DOUBLE, prob=DOUBLE,
)
KEYWORDS = _table(
    window_id=INT, cluster_id=LONG, keywords=STRINGS,
)

# The file data set with everything nested in one row per article
NESTED_ARTICLES = _table(
    id=STRING, date=STRING, title=STRING, text=STRING, sentences=STRINGS, sentence_tokens=TOKEN_LISTS,
    sentence_embds=VECTORS_LIST, story=STRING,
)

REQUIRED_ARTICLE_COLUMNS = ("id", "date", "title", "text")


def require_columns(df: DataFrame, names) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to a table schema; fail when a column is missing."""
    require_columns(df, schema.fieldNames())
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
