"""Streaming scoring and counters match the batch results on the same rows."""

from modeleval.operators.labels import run_counters
from modeleval.plans import catalog as K
from modeleval.plans.evaluate import score
from modeleval.session import scratch_path
from modeleval.streaming import counters_stream, score_stream, write_counters_stream, write_scores_stream
from tests.conftest import SF_SMALL


def test_stream_matches_batch(spark):
    src = f"{SF_SMALL}/lineitem.parquet"
    batch = spark.read.parquet(src)
    stream = (spark.readStream.schema(batch.schema)
              .option("pathGlobFilter", "lineitem.parquet").parquet(SF_SMALL))

    out = scratch_path(spark, "stream-scores")
    q = write_scores_stream(score_stream(stream, K.LI), out)
    q.awaitTermination()
    got = spark.read.parquet(out)
    expected = score(batch, K.LI).filter("is_pos OR is_neg")
    assert got.count() == expected.count()

    q2 = write_counters_stream(counters_stream(stream, K.LI), "me_counters")
    q2.awaitTermination()
    live = spark.sql("SELECT * FROM me_counters").collect()[0].asDict()
    assert live == run_counters(score(batch, K.LI)).collect()[0].asDict()
