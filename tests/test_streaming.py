"""The landing folder as a stream."""

from registrylake.streaming.landing_stream import run_available, stream_lines
from registrylake.tables.permits import drilling_permits


def test_each_landed_file_is_read_once(spark, tmp_path):
    landing, target, progress = tmp_path / "landing", str(tmp_path / "table"), str(tmp_path / "progress")
    landing.mkdir()

    def land(name, n):
        (landing / name).write_text("".join(f"08{i:06d}" + "LEASE".ljust(92) + "00312345\n" for i in range(n)) + "short\n")

    def run():
        lines = stream_lines(spark, str(landing), "*.txt")
        query = run_available(lines, lambda x: drilling_permits(x, "now"), target, progress)
        query.awaitTermination()
        return spark.read.parquet(target).count()

    land("a.txt", 5)
    (landing / "ignored.dat").write_text("x" * 200 + "\n")
    assert run() == 5
    assert run() == 5
    land("b.txt", 3)
    assert run() == 8
    assert {r.api10 for r in spark.read.parquet(target).select("api10").distinct().collect()} == {"4200312345"}
