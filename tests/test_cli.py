"""The command line and the demo."""

import pytest

from tidegate import __main__ as cli
from tidegate.demo import demo
from tidegate.schema import QualityGateFailed

HEADER = "venue_id,venue_name,region,wiki_article\n"


@pytest.fixture
def venues(tmp_path):
    p = tmp_path / "venues.csv"
    p.write_text(HEADER + "".join(f"v{i},V {i},r,Article_{i}\n" for i in range(8)))
    return str(p)


def test_demo(spark, venues, tmp_path):
    (a, b), total, twice = demo(spark, venues, str(tmp_path / "w"))
    assert (a.requests, a.rows_fetched, a.rows_loaded, b.requests, b.rows_loaded, total, twice) == (24, 720, 720, 8, 24, 744, 0)


def test_exit_codes(spark, venues, tmp_path, capsys, monkeypatch):
    args = ["--venues", venues, "--warehouse", str(tmp_path / "w"), "--synthetic"]
    assert cli.main(args) == 0
    assert " ok: 24 requests, 720 fetched, 720 loaded, 0 quarantined (0.00%)" in capsys.readouterr().out

    def refuse(*a, **k):
        raise QualityGateFailed("too bad")

    monkeypatch.setattr(cli, "run", refuse)
    assert cli.main(args) == 1 and "too bad" in capsys.readouterr().err
    monkeypatch.setattr(cli, "run", lambda *a, **k: (_ for _ in ()).throw(OSError("disk")))
    with pytest.raises(OSError):
        cli.main(args)
    with pytest.raises(ValueError):
        (tmp_path / "none.csv").write_text(HEADER)
        cli.main(["--venues", str(tmp_path / "none.csv")])
