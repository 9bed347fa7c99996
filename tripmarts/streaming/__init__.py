"""Live trips with Structured Streaming, using the same operators as the batch jobs."""
