import numpy as np
import pytest

from hitscope.llm import count_min, line_join, repeated_spans

CELLS = 1 << count_min.CHUNK_BITS


@pytest.mark.parametrize("own", [[], [0], [CELLS - 1], [0, 254, 255, 256, 511, 600, CELLS - 1], range(0, CELLS, 9), range(0, CELLS, 8), range(CELLS)])
def test_cells_round_trip(own):
    two = np.zeros(CELLS, bool)
    two[list(own)] = True
    raw = count_min.cells_packed(two)
    assert len(raw) <= CELLS >> 3
    assert np.array_equal(np.unpackbits(count_min.cells_unpacked(raw), bitorder="little").astype(bool), two)


def test_the_table_comes_to_the_driver_in_parts_and_packed(documents, monkeypatch):
    """Before, one collect brought all bits of the table, 32 MB a line, whatever was in it."""
    seen, made = [], count_min.Sketch

    def sketch(rows, lines):
        assert not isinstance(rows, list)
        rows = list(rows)
        seen.extend(r.bits for r in rows if r.line >= 0)
        return made(rows, lines)

    monkeypatch.setattr(count_min, "Sketch", sketch)
    text = " ".join(f"w{i}" for i in range(2000))
    table = count_min.sketch(documents([(1, text), (2, text), (3, "a b c " * 20)]), repeated_spans._window_hashes)
    assert seen and sum(map(len, seen)) < 1 << 21
    assert 2 * 1988 <= table.total <= 2 * 1988 + 60
    assert 1900 <= np.unpackbits(table.lines[0]).sum() <= 2000


def test_lines_leave_no_table_with_the_driver(spark, documents, monkeypatch):
    """Both tables are given up once the classes are stored."""
    kept, context = [], type(spark.sparkContext)
    broadcast = context.broadcast

    def noted(self, value):
        out = broadcast(self, value)
        if isinstance(value, count_min.Sketch):
            kept.append(out)
            destroy = out.destroy
            monkeypatch.setattr(out, "destroy", lambda *a, **b: (kept.remove(out), destroy(*a, **b)), raising=False)
            made.append(1)
        return out

    made = []
    monkeypatch.setattr(context, "broadcast", noted)
    rows = [(1, "one two three four five six\nown line"), (2, "other\none two three four five six")]
    assert sorted(map(tuple, line_join.deduplicate(documents(rows)).collect())) == [(1, 2, 0, rows[0][1]), (2, 2, 1, "other")]
    assert len(made) == 2 and not kept
