"""Message topics. Transport only: the connector comes from the cluster, everything after it is ordinary columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

MESSAGE_FORMAT = "kafka"
_EARLIEST = "earliest"
# Keys of the section that are no reader options: one has a name of its own there, one is a credential.
_NOT_OPTIONS = ("bootstrapServers", "api_key")


def message_options(kafka: Mapping[str, str]) -> dict[str, str]:
    """Reader options from the ``kafka`` part of a dataset spec.

    ``bootstrapServers`` and ``subscribePattern`` are required; every other key goes to the reader as it is: connection
    options with the prefix ``kafka.``, and those of the connector such as ``failOnDataLoss``, ``minPartitions`` or
    ``includeHeaders``. Reading starts at the earliest offset unless the spec says otherwise; a checkpoint wins over
    both.
    """
    missing = [k for k in ("bootstrapServers", "subscribePattern") if not kafka.get(k)]
    if missing:
        raise ValueError(f"message source lacks {', '.join(missing)}")
    options = {"startingOffsets": _EARLIEST}
    options |= {k: _option(v) for k, v in kafka.items() if k not in _NOT_OPTIONS and v is not None}
    return options | client_options(kafka)


def _option(value: object) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


def client_options(kafka: Mapping[str, str]) -> dict[str, str]:
    """Connection options alone, as a writer needs them."""
    options = {k: v for k, v in kafka.items() if k.startswith("kafka.")}
    if kafka.get("bootstrapServers"):
        options["kafka.bootstrap.servers"] = kafka["bootstrapServers"]
    return options


def sasl_plain_options(username: str, password: str, login_module: str) -> dict[str, str]:
    """Login options from credentials the caller has fetched; ``login_module`` names the client's login class."""
    login = f'{login_module} required username="{username}" password="{password}";'
    return {
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": login,
    }


def stream_messages(spark: SparkSession, kafka: Mapping[str, str]) -> DataFrame:
    return spark.readStream.format(MESSAGE_FORMAT).options(**message_options(kafka)).load()
