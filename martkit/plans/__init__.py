"""Whole jobs and the registered check queries."""
