"""Checks of the plans on the driver's tables: derived inputs, registered queries and their SQL."""
