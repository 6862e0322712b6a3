"""Named queries over the order tables, each with its SQL equivalent where one exists."""
