"""Ticket-sales ELT and analytics as lazy Spark plans."""
