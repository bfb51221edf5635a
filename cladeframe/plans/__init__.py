"""Adapters from the driver's tables to domain tables, and the registered queries."""
