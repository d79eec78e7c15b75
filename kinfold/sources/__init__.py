"""Readers: exported API responses, the data dictionary, wearable export files."""

from kinfold.sources.envelope import (read_dictionary, read_envelope, read_participants,  # noqa: F401
                                      read_surveys)
from kinfold.sources.wearables import (hrv_file_index, load_hrv, load_readiness,  # noqa: F401
                                       load_resting_hr)
