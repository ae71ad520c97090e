import json

from playlake.__main__ import main
from playlake.session import scratch_path


def test_cli_backfill_and_views(spark, write_jsonl, capsys):
    rec = {"appid": 7, "success": True, "fetched_at": "2024-01-05T01:00:00",
           "data": {"name": "g", "recommendations": {"total": 3}, "genres": [{"id": "1", "description": "RPG"}]}}
    root = write_jsonl("b/year=2024/month=01/day=05/a.jsonl.gz", [rec])
    base = scratch_path(spark, "t_cli")
    args = ["--bronze", f"{root}/b", "--silver", f"{base}/s", "--gold", f"{base}/g", "--profile", "local"]
    assert main(["backfill", *args, "--start", "2024-01-04", "--end", "2024-01-05"]) == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert [(r["status"], r["silver_rows"]) for r in report] == [("skipped", 0), ("loaded", 1)]
    assert main(["views", "--gold", f"{base}/g", "--profile", "local",
                 "--sql", "SELECT genre, genre_growth_1d FROM view_genre_growth"]) == 0
    assert "RPG" in capsys.readouterr().out


def test_cli_growth_then_compact_dim(spark, write_jsonl, capsys):
    rec = {"appid": 9, "success": True, "fetched_at": "2024-01-06T01:00:00",
           "data": {"name": "h", "recommendations": {"total": 5}, "publishers": ["P"]}}
    root = write_jsonl("c/year=2024/month=01/day=06/a.jsonl.gz", [rec])
    base = scratch_path(spark, "t_cli_growth")
    common = ["--gold", f"{base}/g", "--profile", "local"]
    main(["backfill", "--bronze", f"{root}/c", "--silver", f"{base}/s", *common, "--start", "2024-01-06",
          "--end", "2024-01-06"])
    capsys.readouterr()
    assert main(["growth", *common, "--out", f"{base}/growth",
                 "--start", "2024-01-06", "--end", "2024-01-06"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["growth"] == "rebuilt"
    assert main(["compact-dim", *common]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"versions_kept": 1}
