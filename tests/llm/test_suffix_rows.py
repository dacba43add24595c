"""op6: the rows of every step follow the places of a hot class, not its strings."""
import numpy as np

from citesight.llm import suffixes


def near_copies(n, size=900, edits=3):
    """Copies of one text with a few letters changed in each."""
    rng = np.random.default_rng(11)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz ", dtype=np.uint8)
    first = rng.choice(letters, size)
    out = []
    for _ in range(n):
        b = first.copy()
        b[rng.integers(0, size, edits)] = rng.choice(letters, edits)
        out.append(b.tobytes())
    return out


def test_rows_of_hot_classes(spark, monkeypatch):
    monkeypatch.setattr("citesight.llm.suffixes.HOT", 10)
    made, write = [], suffixes.materialize

    def counted(df):
        out = write(df)
        made.append((out.columns, out.count()))
        return out

    monkeypatch.setattr("citesight.llm.suffixes.materialize", counted)
    raws = near_copies(150)
    docs = spark.createDataFrame([(i, b.decode()) for i, b in enumerate(raws)], "doc_id long, text string")
    got = {r.doc_id: r for r in suffixes.remove_repeats(docs).collect()}
    count = {}
    for b in raws:
        for i in range(len(b) - 399):
            count[b[i:i + 400]] = count.get(b[i:i + 400], 0) + 1
    for i, b in enumerate(raws):
        gone = np.zeros(len(b), dtype=bool)
        for k in range(len(b) - 399):
            if count[b[k:k + 400]] > 1:
                gone[k:k + 400] = True
        assert got[i].n_removed == gone.sum()
        assert (got[i].kept or b) == np.frombuffer(b, dtype=np.uint8)[~gone].tobytes() or gone.all()
    places = next(n for columns, n in made if columns == ["rid", "key", "a", "p0", "p1"])
    assert max(n for _, n in made) <= 4 * places
    assert sum("d1" in columns for columns, _ in made) > 4  # contexts, then blocks


def test_blocks_that_share_a_string_share_a_class():
    rng = np.random.default_rng(2)
    a = rng.choice(np.frombuffer(b"abcd", dtype=np.uint8), 1200).tobytes()
    for part in suffixes.PARTS:
        for s in range(350, 640):  # the block of either text, cropped in its own way
            anchor = 660
            b = rng.choice(np.frombuffer(b"abcd", dtype=np.uint8), s).tobytes() + a[s:s + 400] + b"z" * 200
            assert suffixes.block_class(a, anchor, s, part) == suffixes.block_class(b, anchor, s, part)
