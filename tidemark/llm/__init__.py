"""Training-data operators; see each module. Nothing else in the library imports this subpackage."""
