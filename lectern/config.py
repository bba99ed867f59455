"""Job parameters."""

from dataclasses import dataclass

# Content types, in declaration order.
CONTENT_TYPES = ("URI", "YOUTUBE", "TEXT", "AUDIO", "VIDEO", "PDF", "YOUTUBE_LIST")


@dataclass(frozen=True)
class JobConfig:
    """Defaults of a processing job; pass a changed copy to the operators."""

    # Defaults every job starts from.
    min_text_block: int = 100
    words_per_minute: int = 350
    espeak_voice: str = "f5"
    atempo: str = "2.0"
    title_limit: int = 40
    submitted_with: str = "api"

    # Code points of the text that stand in for a missing title.
    text_title_chars: int = 64
    # Width of the page buckets that section ranges are joined on.
    page_bucket: int = 64
    # Outline lines ranked together before the cross-chunk step.
    outline_chunk: int = 10_000
    # Largest table, in bytes, handed to a broadcast after it was measured.
    broadcast_bytes: int = 64 * 1024 * 1024


DEFAULTS = JobConfig()
