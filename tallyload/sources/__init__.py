"""Scans: command files (A1), data files by profile (A4-A6), file sizes."""

from tallyload.sources.commands import command_scan, with_line_positions
from tallyload.sources.datafiles import data_scan, file_inventory
from tallyload.sources.profiles import PROFILES, LoadProfile

__all__ = ["PROFILES", "LoadProfile", "command_scan", "data_scan", "file_inventory", "with_line_positions"]
