"""The command-line study prints the six purity lines."""

import re

from .conftest import SF0001


def test_cli_prints_six_report_lines(spark, capsys):
    from medcohort.__main__ import main
    main(["--tables", SF0001])
    lines = [ln for ln in capsys.readouterr().out.splitlines() if ln.strip()]
    assert len(lines) == 6
    pattern = re.compile(r"^\[(All|Filtered) feature\] getPurity of (kMeans|GMM|StreamingKmeans) is: \d\.\d{5}$")
    assert all(pattern.match(ln) for ln in lines), lines
