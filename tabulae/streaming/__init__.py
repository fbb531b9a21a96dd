from tabulae.streaming.deliveries import read_typed, stream_deliveries, text_schema  # noqa: F401
