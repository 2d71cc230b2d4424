import math

import pytest

from statloom import Metadata, attach, detach


def survey():
    return Metadata(
        variable_labels={"a": "A", "b": "B", "c": "C", "d": "D"},
        value_labels={"a": [{"value": 1.0, "label": "one"}, {"value": 1.5, "label": "more"}]},
        missing_values={"b": {"lo": -math.inf, "hi": 0, "value": 99}},
        file_label="File",
        notes=["n"],
    )


def test_repr_is_short():
    lines = repr(survey()).splitlines()
    assert lines[0] == "Metadata(" and lines[-1] == ")"
    assert lines[1] == "    variable_labels={'a': 'A', 'b': 'B', 'c': 'C', ... +1 more},"
    assert lines[-2] == "    multiple_response_sets=[]"
    assert "    file_label='File'," in lines and "    notes=['n']," in lines


def test_rename_keeps_places_and_the_original():
    old = survey()
    new = old.rename_variable("a", "z")
    assert list(new.variable_labels) == ["z", "b", "c", "d"]
    assert "z" in new.value_labels and "a" in old.value_labels
    with pytest.raises(ValueError, match="'b' has attributes"):
        old.rename_variable("a", "b")


def test_merge_prefers_self_and_joins_lists():
    other = Metadata(variable_labels={"a": "other", "x": "X"}, file_label="Other", notes=["m"], multiple_response_sets=[{"name": "s"}])
    both = survey().merge(other)
    assert both.variable_labels["a"] == "A" and both.variable_labels["x"] == "X"
    assert both.file_label == "File" and both.notes == ["n", "m"] and both.multiple_response_sets == [{"name": "s"}]
    assert Metadata().merge(other).file_label is None


def test_select_keeps_the_file_level():
    some = survey().select(["b", "nowhere"])
    assert list(some.variable_labels) == ["b"] and some.value_labels == {} and some.file_label == "File"


def test_integer_codes():
    labels = survey().with_integer_codes(["a"]).value_labels["a"]
    assert [c["value"] for c in labels] == [1, 1.5] and isinstance(labels[0]["value"], int)
    assert isinstance(survey().with_integer_codes([]).value_labels["a"][0]["value"], float)


def test_attach_survives_select_and_filter(spark):
    df = attach(spark.createDataFrame([(1.0, 2.0)], "a double, b double"), survey())
    back = detach(df.filter("a > 0").select("b", "a"))
    assert back.variable_labels == {"b": "B", "a": "A"}
    assert back.missing_values["b"] == {"lo": -math.inf, "hi": 0, "value": 99}
