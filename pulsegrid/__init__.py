"""pulsegrid: a Spark-native feature engine for OpenTelemetry logs, spans and metrics."""
