"""Query registrations grouped by area; see ``lakeloom.catalog``."""
