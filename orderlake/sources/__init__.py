"""Where raw tables come from and where finished tables go."""
