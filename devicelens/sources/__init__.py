"""Readers: device messages, comma text lines, stored hourly readings."""

from .hours import read_hours
from .lines import format_reading_lines, parse_reading_lines, read_reading_lines, read_text_hours
from .paths import prefix_cover, range_alternatives
from .messages import message_file_stream, message_records, parse_device_messages, stream_device_messages

__all__ = [
    "format_reading_lines",
    "message_file_stream",
    "message_records",
    "parse_device_messages",
    "parse_reading_lines",
    "read_hours",
    "prefix_cover",
    "range_alternatives",
    "read_reading_lines",
    "read_text_hours",
    "stream_device_messages",
]
