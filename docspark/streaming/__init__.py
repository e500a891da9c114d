"""File-stream intake (T1-T4): documents arriving as files are validated, split,
summarised and indexed per micro-batch; sinks are keyed by batch id so a replayed
batch overwrites itself (exactly-once results from at-least-once execution)."""
