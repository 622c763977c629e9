"""Fixed values of the detector record formats."""

from __future__ import annotations

from dataclasses import dataclass

# Record type bytes (fixed values).
MARKER = 254
END_OF_FILE = 255
TRAIN_DETAIL = 249
LAST_FPOD_CLICK_TYPE = 183
FPOD_IGNORED_TYPES = (247, 248, 250, 252, 253, 255)

# Start minute: big-endian count of minutes since this instant, at bytes 257-260 of the header.
CLOCK_BASE = "1899-12-30 00:00:00"
START_MINUTE_BYTES = (257, 260)
TILT_BYTES = (65, 66)
VERSION_BYTES = (40, 41)
EXTENDED_AMPS_ABOVE_VERSION = 801

# Time stamp ticks to microseconds.
TICK_US = 5

QUALITY_LABELS = ("Doubtful", "Low", "Medium", "High")
CPOD_SPECIES_LABELS = ("NBHF", "Dolphin", "Unclass.", "Sonar", "HEL1")
FPOD_SPECIES_LABELS = ("NBHF", "Dolphin", "Unclass.", "Sonar", "possibleSonar")
UNKNOWN_SPECIES = "Unknown"

BUZZ_US = 40_000
LOST_MINUTE_ABOVE = 4096
RECORDED_BELOW_ANGLE = 80


@dataclass(frozen=True)
class Layout:
    """Fixed-width record file: header length, record length and 1-based type byte."""

    name: str
    header_bytes: int
    record_bytes: int
    type_byte: int
    dropped_types: tuple[int, ...] = ()


LAYOUTS = {
    "CP1": Layout("CP1", 360, 10, 10, (END_OF_FILE,)),
    # A CP3 file ends at its first end-of-file record, so that record has to stay visible.
    "CP3": Layout("CP3", 760, 40, 40),
    "FP1": Layout("FP1", 1024, 16, 1, (END_OF_FILE,)),
    "FP3": Layout("FP3", 1024, 16, 1, FPOD_IGNORED_TYPES),
}
