"""Operators the reference needs beyond single Spark calls, as DataFrame compositions."""
