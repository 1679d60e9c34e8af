"""The supplied test tables read as the retail model, queries over them, and their SQL."""
