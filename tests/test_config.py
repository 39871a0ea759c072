import pytest

from stampcard import EngineConfig, parse_points_sequence


def test_defaults():
    cfg = EngineConfig()
    assert cfg.points_ladder == (1, 2, 3, 5, 8, 13, 21)
    assert cfg.max_per_month == 7
    assert cfg.state_ttl_ms == 604_800_000
    assert (cfg.checkpoint_interval_ms, cfg.parallelism) == (60_000, 4)


@pytest.mark.parametrize(
    ("text", "ladder"),
    [("1,2,3", (1, 2, 3)), (" 1 , 20", (1, 20)), ("4", (4,)), ("1,2,,", (1, 2)), ("-1,+2", (-1, 2))],
)
def test_ladder(text, ladder):
    assert parse_points_sequence(text) == ladder


@pytest.mark.parametrize("text", ["", ",", "1,,2", "a", "1.5", "1_0", "1,2, "])
def test_bad_ladder(text):
    with pytest.raises(ValueError):
        parse_points_sequence(text)


def test_options():
    cfg = EngineConfig.from_options(
        {"points.sequence": "5,6", "max.checkin.per.month": "3", "parallelism": "16", "kafka.topic": "t"}
    )
    assert cfg.points_ladder == (5, 6)
    assert (cfg.max_per_month, cfg.parallelism, cfg.kafka_topic) == (3, 16, "t")
    assert cfg.kafka_output_topic == EngineConfig().kafka_output_topic


def test_unknown_modes_are_refused():
    with pytest.raises(ValueError):
        EngineConfig(order_mode="other")
    with pytest.raises(ValueError):
        EngineConfig(id_mode="other")
    with pytest.raises(ValueError):
        EngineConfig(points_ladder=())


def test_ladder_values_fit_32_bits_and_the_password_is_not_shown():
    with pytest.raises(ValueError):
        parse_points_sequence("1,2147483648")
    assert "secret" not in repr(EngineConfig(jdbc_password="secret"))
