"""The layers put together: cleaned feeds, dimensions, fact, reports, full run."""
