"""Wire decode job: framing, proto3 defaults, tombstones and rejects."""

from secflow import schemas as S
from secflow.sources.decode import decode_findings, encode_findings, frame, message_class, unframe


def test_roundtrip_and_rejects(spark):
    rows = [(b"k", "t", "a", "server", "10.0.0.1", "CVE-1", None, "HIGH", 0.5, S.FINDING_TYPE_ML, "HIGH",
             S.MODEL_VERSION_ML, "2026-08-27 10:30:00.000")]
    enc = encode_findings(spark.createDataFrame(rows, S.FINDING), schema_id=42).collect()
    good = bytes(enc[0].value)
    assert unframe(good)[0] == 42
    records = spark.createDataFrame([(good,), (b"",), (None,), (b"\x01junkjunk",), (frame(b"\xff\xff", 7),)],
                                    "value binary")
    ok, bad = decode_findings(records)
    got = ok.collect()
    assert len(got) == 1 and got[0].cvss_score == 0.0 and got[0].anomaly_score == 0.5 and got[0].schema_id == 42
    assert bad.count() == 2


def test_message_class_fields():
    m = message_class()(tenant_id="t", cvss_score=9.8)
    m2 = message_class()()
    m2.ParseFromString(m.SerializeToString())
    assert m2.tenant_id == "t" and m2.cvss_score == 9.8 and m2.severity == ""


def test_framings_of_one_batch_and_what_is_absent(spark):
    """Frames of several lengths and schema ids, NaN and missing fields, rejects between good rows."""
    msg = message_class()(tenant_id="tä", cvss_score=9.8, event_time="2026-08-27 10:30:00.000").SerializeToString()
    values = [frame(msg, 7), b"\x00\x00\x00\x00\x09\x02\x02" + msg, frame(msg, 8), b"\x00junk", frame(b"", 7),
              frame(b"\x0a\x02\xff\xfe", 7), frame(msg, 7)]
    ok, bad = decode_findings(spark.createDataFrame([(v,) for v in values], "value binary").coalesce(1))
    assert [(r.schema_id, r.tenant_id, r.cvss_score) for r in ok.collect()] == [
        (7, "tä", 9.8), (9, "tä", 9.8), (8, "tä", 9.8), (7, "", 0.0), (7, "tä", 9.8)]
    assert [bytes(r._raw) for r in bad.collect()] == [values[3], values[5]]
    row = (b"k", None, "a", "server", None, "CVE-1", float("nan"), "HIGH", 0.5, None, "", "v", None)
    back, _ = decode_findings(encode_findings(spark.createDataFrame([row], S.FINDING)))
    assert tuple(back.collect()[0])[:12] == ("", "a", "server", "", "CVE-1", 0.0, "HIGH", 0.5, "", "", "v", "")


def test_decoded_rows_are_shuffled_once_and_stay_in_arrow(spark):
    from secflow.operators import findings
    ok, _ = decode_findings(encode_findings(spark.createDataFrame([], S.FINDING)))
    plan = findings.documents(ok, by_asset=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("MapInArrow") == 2 and "MapInPandas" not in plan
