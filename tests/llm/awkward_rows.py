"""Documents with every awkward case in one table."""

from __future__ import annotations

LONG = " ".join(f"word{i % 997}x{i}" for i in range(40_000))
TEXT = "The quick brown fox jumps over the lazy dog while nobody at all is watching it do so again"
# Names that the operators also use themselves.
EXTRA = ("fp", "batch", "component_id", "spans", "removed", "label", "rank", "length", "rest", "epoch", "copy", "node")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint" + "".join(
    f", {name} string" for name in EXTRA
)


def row(doc_id, text, lang="en", source="src1"):
    return (doc_id, text, lang, source, None if text is None else len(text), *(["x"] * len(EXTRA)))


AWKWARD = [
    row(1, TEXT),
    row(2, TEXT),
    row(2, TEXT),
    row(3, None),
    row(4, ""),
    row(5, "", None, None),
    row(None, TEXT),
    row(None, None, None, None),
    row(6, LONG),
    row(7, LONG + " tail"),
    row(8, " \t\r\n\x0b\x0c ", "fr", "src2"),
    row(9, "word"),
    row(9, "other words here"),
    row(10, "éà ß 中文 字 \U0001f600 " * 30, "de", "src3"),
]
