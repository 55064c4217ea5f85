import json

import pytest

from signalstats.model import JobConfig, TopicConfig
from signalstats.session import SETTINGS, ship_package, tune
from signalstats.streaming import app

CONFIG = {
    "appName": "aggregation",
    "triggerInterval": "10 seconds",
    "outputMode": "update",
    "checkpointPath": "/shared/checkpoint",
    "windowInterval": 5,
    "watermarkInterval": 10,
    "core": {"spark.scheduler.mode": "FIFO", "spark.port.maxRetries": 16},
    "callEventsTopic": {
        "topic": "call.events",
        "subscriptionType": "subscribe",
        "conf": {"kafka.bootstrap.servers": "broker:9092", "failOnDataLoss": False},
    },
}


def test_configuration_file(tmp_path):
    path = tmp_path / "config.json"
    path.write_text(json.dumps(CONFIG))
    config = app.load_config(str(path))
    assert (config.app_name, config.window_minutes, config.watermark_minutes) == ("aggregation", 5, 10)
    assert (config.trigger_interval, config.output_mode, config.checkpoint_path) == ("10 seconds", "update", "/shared/checkpoint")
    assert config.spark_conf["spark.port.maxRetries"] == 16
    assert config.source == TopicConfig("call.events", "subscribe", CONFIG["callEventsTopic"]["conf"])
    assert config.sink is None


def test_unknown_settings_are_refused():
    with pytest.raises(ValueError, match="windowMinutes"):
        JobConfig.from_mapping({"windowMinutes": 5})


def test_the_application_needs_a_configuration(capsys):
    assert app.main([]) == 2
    assert "usage" in capsys.readouterr().err


def test_tune_leaves_launch_settings_alone(spark, conf):
    key = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    conf(key, "7")
    tune(spark)
    # This session was launched with the setting, so a later change is kept.
    assert spark.conf.get(key) == "7"
    assert key in SETTINGS


def test_shipped_package_is_sent_once(spark):
    ship_package(spark)
    ship_package(spark)
    files = [str(f) for f in spark.sparkContext.listFiles]
    assert sum("signalstats.zip" in f for f in files) <= 1
