"""Readers, writers and the adapter from an event table to the roles the operators use."""
