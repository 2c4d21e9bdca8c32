"""Word lists are written for the sets that a sketch leaves open, not for all that share a token."""
from strata.llm import cpsjoin_dedup


def test_word_lists_of_sets_that_sketches_rule_out_are_not_written(make, monkeypatch):
    texts = [f"some common words{i} and{i} others{i} here{i}" if i % 2 else f"x{i} some common words y{i} z{i}" for i in range(60)]
    near = " ".join(f"w{i}" for i in range(200))
    texts += [near, near + " end", near]
    written, own = [], cpsjoin_dedup.materialize

    def spy(df):
        out = own(df)
        if out.columns == ["set_id", "body"]:
            written.append(out.count())
        return out

    monkeypatch.setattr(cpsjoin_dedup, "materialize", spy)
    unlike = [f"a b c d{i} e{i} f{i}" for i in range(60)]  # share a shingle, so most meet in some tree
    rows = {r["doc_id"]: r["component_id"] for r in cpsjoin_dedup.near_duplicates(make(unlike + texts), 3, 85).collect()}
    assert len(rows) == 123 and sum(k != v for k, v in rows.items()) == 2
    assert written == [2]
