"""Named reports over the ticket, log, settings and access tables."""
