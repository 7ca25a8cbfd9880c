"""Jobs: operators wired to the paths of a lake."""
