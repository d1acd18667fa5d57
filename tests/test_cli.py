"""The command line lists every registered query with a description."""

from tessera.__main__ import main
from tessera.plans.catalog import QUERIES


def test_list_names_every_query_with_a_description(capsys):
    assert main(["list"]) == 0
    lines = capsys.readouterr().out.strip().splitlines()
    assert len(lines) == len(QUERIES)
    for line in lines:
        name, _, desc = line.partition(" ")
        assert name in QUERIES and desc.strip()
