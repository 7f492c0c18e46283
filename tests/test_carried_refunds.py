"""Refunds that are carried over, against the state of a plain stream."""

from shelflens.streaming.fraud import keyed_fraud_patterns, stream_fraud_patterns
from tests.test_carried import run, send
from tests.test_streaming import REFUNDS, SPANS, flagged, refunds_of


def test_refunds_alike_from_carried_rows_and_from_a_state(spark, tmp_path):
    """Null and not-a-number amounts, null ids, repeats in a later micro-batch, late refunds; no state in memory."""
    days = [(0, 1, "a", 0, 60.0), (1, 1, "a", 1, None), (2, 1, None, 2, float("nan")), (3, None, "a", 2, 70.0), (4, 2, "b", 30, 95.5)]
    later = [(0, 1, "a", 0, 60.0), (5, 1, "a", 31, 61.0), (6, 2, "b", 3, 10.0), (7, 2, "b", 59, 80.0)]
    last = [(8, 2, "b", 27, 10.0), (9, 1, "a", 89, 10.0), (99, 77, "z", 2000, 1.0)]
    found = []
    for make in (stream_fraud_patterns, keyed_fraud_patterns):
        folder = str(tmp_path / make.__name__)
        for part in (days, later, last):
            send(refunds_of(spark, part), folder)
            query = run(spark, REFUNDS, lambda stream: make(stream, SPANS, "31 days"), folder)  # noqa: B023
        assert any(p.stateOperators for p in query.recentProgress) == (make is keyed_fraud_patterns)
        found.append(flagged(spark.read.parquet(f"{folder}/out")))
    assert found[0] == found[1] and [r[0] for r in found[0]] == [f"r{i}" for i in (0, 1, 2, 3, 4, 5, 6, 7, 9)]
