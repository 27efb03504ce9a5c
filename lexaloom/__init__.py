"""lexaloom: DataFrame operators that turn source material into a curriculum."""
