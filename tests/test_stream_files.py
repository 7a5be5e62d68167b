"""The stream's input has as many files as its text needs, not a fixed number."""

from pathlib import Path

from storyloom.plans import queries


def test_files_of_the_stream_follow_the_text(spark, tiny, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "new_workspace", lambda spark, name: str(tmp_path / name))
    monkeypatch.setattr(queries, "text_tasks", lambda rows: 9, raising=False)
    assert queries.QUERIES["streamed_term_windows"](spark, tiny).count() > 0
    assert len(list(Path(tmp_path / "stream" / "in").glob("part-*.parquet"))) > 4
