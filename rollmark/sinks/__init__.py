"""Writers that can be run again without harm."""
