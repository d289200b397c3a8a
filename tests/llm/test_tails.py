"""Limits of measures that most texts have none of follow the tail of the group."""

from civicpanel.llm import quality_rules


def test_groups_with_different_tails_get_different_limits(frame):
    """In both groups the medians are 0; a fifth of the one has a quarter of its lines twice."""
    line = lambda i, j: " ".join(f"w{i}x{j}y{k}" for k in range(12))

    def text(i, twice):
        lines = [line(i, j) for j in range(8)]
        lines[8 - twice :] = lines[:twice]
        return "\n".join(lines)

    rows = [(i, text(i, 0), "en", "prose", 1) for i in range(300)]
    rows += [(1000 + i, text(1000 + i, 2 if i % 5 == 0 else 0), "en", "lists", 1) for i in range(300)]
    rows += [(5000, text(5000, 2), "en", "prose", 1), (5001, text(5001, 2), "en", "lists", 1)]
    df = frame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    limits = quality_rules.thresholds(quality_rules.sketches(quality_rules.counted(df))).where("level = 2").collect()
    high = {r.source: r.high_duplicate_lines for r in limits}
    assert high["prose"] < 2500 < high["lists"]
    found = {r.doc_id: (r.kept, r.reasons) for r in quality_rules.judged(df.where("doc_id >= 0")).collect()}
    assert "high_duplicate_lines" in found[5000][1]
    assert "high_duplicate_lines" not in found[5001][1] + found[1000][1]
