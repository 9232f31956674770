"""Nightsift: Spark jobs for sky-survey transient reports."""
