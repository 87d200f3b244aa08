import pytest

from revlens.params import ModelParams, ParamError, Params, QualityParams


def test_defaults_and_repeated_targets():
    params = Params(target_languages=("fr", "de", "fr"))
    assert params.target_languages == ("fr", "de")
    assert params.passthrough_language == "en"
    assert (params.quality.threshold, params.quality.scale_min, params.quality.scale_max) == (3.0, 1, 5)


@pytest.mark.parametrize(
    "make",
    [
        lambda: Params(target_languages=()),
        lambda: Params(target_languages=("xx",)),
        lambda: Params(target_languages=("en",)),
        lambda: Params(target_languages=("fr",), passthrough_language="xx"),
        lambda: QualityParams(scale_min=5, scale_max=5),
        lambda: QualityParams(threshold=0.5),
        lambda: QualityParams(threshold=5.5),
        lambda: ModelParams(model_id=""),
        lambda: ModelParams(max_tokens=0),
        lambda: ModelParams(temperature=1.5),
        lambda: Params.from_dict({"target_languages": ["fr"]}),
        lambda: Params.from_dict({"models": {}}),
    ],
)
def test_rules(make):
    with pytest.raises(ParamError):
        make()


def test_threshold_on_the_bounds_and_null_temperature():
    assert QualityParams(threshold=1).threshold == 1
    assert QualityParams(threshold=5).threshold == 5
    assert ModelParams(temperature=0.0).temperature == 0.0
    assert ModelParams().temperature is None


def test_from_dict():
    params = Params.from_dict(
        {
            "target_languages": ["fr", "de"],
            "quality": {"threshold": 2.5},
            "models": {
                "summarization": {"model_id": "a", "max_tokens": 10},
                "quality_scoring": {"model_id": "b", "temperature": 0.0},
            },
        }
    )
    assert params.quality.threshold == 2.5
    assert params.summary_model.max_tokens == 10
    assert params.judge_model.max_tokens == 512
