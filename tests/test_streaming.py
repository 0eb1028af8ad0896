from conftest import rows

from cartyield.plans import queries
from cartyield.streaming.twu import TwuStore, accumulate_twu


def test_twu_goes_on_and_a_batch_replayed_changes_nothing(spark, tmp_path):
    inbox, checkpoint = tmp_path / "inbox", tmp_path / "seen"
    inbox.mkdir()
    store = TwuStore(spark, str(tmp_path / "store"))

    def totals():
        return {item: float(twu) for item, twu in rows(store.read())}

    (inbox / "a.txt").write_text("A:1:2 B:1:3 :5\nA:1:1 A:2:1 :3\n# comment\n")
    accumulate_twu(spark, str(inbox), store, str(checkpoint))
    assert totals() == {"A": 8.0, "B": 5.0}
    (inbox / "b.txt").write_text("B:1:4 C:1:1 :5\n")
    for _ in range(2):  # the second time there is nothing new
        accumulate_twu(spark, str(inbox), store, str(checkpoint))
        assert totals() == {"A": 8.0, "B": 10.0, "C": 5.0}
    # As if the run had failed after storing the last batch and before saying so.
    commits = sorted((p for p in (checkpoint / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    for name in (commits[-1].name, f".{commits[-1].name}.crc"):
        (checkpoint / "commits" / name).unlink(missing_ok=True)
    accumulate_twu(spark, str(inbox), TwuStore(spark, str(tmp_path / "store")), str(checkpoint))
    assert totals() == {"A": 8.0, "B": 10.0, "C": 5.0}


def test_lines_of_two_drops_are_made_once(spark, monkeypatch):
    made, render = [], queries.text_sink.render_lines
    monkeypatch.setattr(queries.text_sink, "render_lines", lambda items: made.append(items) or render(items))
    assert queries.twu_in_drops(spark, "/root/testdata/sf0.001").count() == 25
    assert len(made) == 1
