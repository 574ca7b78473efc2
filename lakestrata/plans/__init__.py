"""The four data domains expressed with the operators."""
