"""Intentionally empty: the reference has no stream, watermark, windowed
aggregation or stateful operator; every workload is a batch run."""
