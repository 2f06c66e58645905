"""Entity profiles from observation streams, written as Spark DataFrame jobs."""

from dossierlake.dictionary import AttrDictionary
from dossierlake.session import build_session, pin_utc, work_dir

__all__ = ["AttrDictionary", "build_session", "pin_utc", "work_dir"]
