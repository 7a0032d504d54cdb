import pytest

from evigraph import __main__ as cli
from evigraph.plans import all_registries


def test_commands_name_queries(capsys):
    known = {k for r in all_registries() for k in r.queries}
    assert set(cli.COMMANDS.values()) <= known
    assert cli.main(["list"]) == 0 and "propose-pages" in capsys.readouterr().out
    assert cli.main([]) == cli.main(["stats"]) == cli.main(["run", "nothing", "a", "b"]) == cli.main(["search", "a", "b", "upside-down"]) == 2


def test_a_command_writes_its_rows(spark, small, tmp_path, capsys):
    assert cli.main(["stats", small, str(tmp_path / "out")]) == 0
    assert {r.what for r in spark.read.parquet(str(tmp_path / "out")).collect()} >= {"nodes", "claims"}
    assert cli.main(["salience", small]) == 0 and "salience" in capsys.readouterr().out


def test_search_and_show(spark, small):
    words = cli.search(small, "radar return", "keyword").collect()
    assert words and all("radar" in r.content.lower() or "return" in r.content.lower() for r in words) and [r.score for r in words] == sorted([r.score for r in words], reverse=True)
    assert cli.search(small, "radar return").columns == ["id", "score", "content"]
    with pytest.raises(ValueError):
        cli.search(small, "radar", "semantic")
    e = lambda text: [1.0] * 64
    assert cli.search(small, "radar", "semantic", e).columns == ["id", "distance", "content"] and cli.search(small, "radar return", "hybrid", e).count() > 0
    name = spark.read.parquet(f"{small}/nodes.parquet").where("retired_at IS NULL AND name IS NOT NULL").orderBy("id").first().name
    assert name in {r.name for r in cli.show(small, name).collect()}
