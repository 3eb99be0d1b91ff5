"""Word lists and catalogue literals in source text."""

import lzma

from scriptorium.sources import books as B


def test_words(spark, tmp_path):
    body = "# head\nOne\n\ntwo\none\n"
    (tmp_path / "w.txt").write_text(body)
    (tmp_path / "w.txt.xz").write_bytes(lzma.compress(body.encode()))
    for name in ("w.txt", "w.txt.xz"):
        assert sorted(r["word"] for r in B.read_words(spark, str(tmp_path / name)).collect()) == ["one", "two"]


def test_literals(spark, tmp_path):
    source = 'let all: [Item] = [\n    Item(\n        slug: "a", group: .six,\n        title: "T (\\"x\\") \\u{41}",\n        aliases: ["a1", "a2"]\n    ),\n    Item(\n        slug: "b", group: .rest,\n        aliases: []\n    ),\n    ]\n'
    (tmp_path / "s.swift").write_text(source)
    got = [tuple(r) for r in B.read_catalog_literals(spark, str(tmp_path / "s.swift"), "Item", ["slug", "title"]).orderBy("position").collect()]
    assert got == [(0, "six", "a", 'T ("x") A', ["a1", "a2"]), (1, "rest", "b", None, [])]
