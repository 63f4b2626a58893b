"""The crawl topic: message frames and connection options.

The Kafka connector is an optional Spark package; these functions only build the frame and the
options, so everything except the connection itself works without it.
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlweave.functions.messages import encode_message

# Connection defaults.
DEFAULT_SERVERS = "localhost:9095"
DEFAULT_TOPIC = "pages"
DEFAULT_TRUSTSTORE = "certs/kafka.truststore.jks"
TLS_VERSIONS = "TLSv1.2,TLSv1.3"


def topic_messages(pages: DataFrame) -> DataFrame:
    """``key, value`` of every page; both are the whole message."""
    message = encode_message(F.col("depth"), F.col("url"))
    return pages.select(message.alias("key"), message.alias("value"))


def tls_options(environ: Mapping[str, str] | None = None, check_host: bool = True) -> dict[str, str]:
    """Connection security. The store's password comes from the environment, or there is none.

    ``check_host=False`` accepts a certificate made for another host, as with self-signed development
    certificates; the trust anchor is still checked.
    """
    env = os.environ if environ is None else environ
    return {
        "kafka.security.protocol": "SSL",
        "kafka.ssl.truststore.location": env.get("KAFKA_SSL_TRUSTSTORE_LOCATION", DEFAULT_TRUSTSTORE),
        **({"kafka.ssl.truststore.password": env["KAFKA_SSL_STORE_PASSWORD"]} if env.get("KAFKA_SSL_STORE_PASSWORD") else {}),
        "kafka.ssl.truststore.type": "JKS",
        "kafka.ssl.enabled.protocols": TLS_VERSIONS,
        "kafka.ssl.endpoint.identification.algorithm": "https" if check_host else "",
    }


def sink_options(servers: str = DEFAULT_SERVERS, topic: str = DEFAULT_TOPIC, environ=None) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "1", **tls_options(environ)}


def source_options(servers: str = DEFAULT_SERVERS, topic: str = DEFAULT_TOPIC, environ=None) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest",
        **tls_options(environ),
    }


def publish(pages: DataFrame, **where) -> None:
    topic_messages(pages).write.format("kafka").options(**sink_options(**where)).save()


def subscribe(spark: SparkSession, **where) -> DataFrame:
    raw = spark.readStream.format("kafka").options(**source_options(**where)).load()
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"), "timestamp")
