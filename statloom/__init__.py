"""Statistical-file analytics on Spark: SPSS and Stata files as DataFrames with their metadata."""

import sys

from pyspark import cloudpickle

from .errors import StatError, StatWarning
from .formats import SavCompression, TextLimitPolicy
from .metadata import Alignment, Code, Measure, Metadata, Missingness, MissingRange, MissingValues, Value, attach, detach
from .sources.datasource import register
from .sources.files import DtaWriter, SavWriter, read_dta, read_dta_metadata, read_sav, read_sav_metadata, write_dta, write_parts, write_sav
from .streaming.batches import DtaStreamingReader, SavStreamingReader, StatReader, open_dta, open_sav

__version__ = "0.1.0"

__all__ = [
    "Alignment", "Code", "DtaStreamingReader", "DtaWriter", "Measure", "Metadata", "MissingRange", "MissingValues", "Missingness",
    "SavCompression", "SavStreamingReader", "SavWriter", "StatError", "StatReader", "StatWarning", "TextLimitPolicy", "Value", "attach",
    "detach", "open_dta", "open_sav", "read_dta", "read_dta_metadata", "read_sav", "read_sav_metadata", "register", "write_dta", "write_parts",
    "write_sav",
]

# functions that run on executors travel with the job, so the executors need no installation
cloudpickle.register_pickle_by_value(sys.modules[__name__])
