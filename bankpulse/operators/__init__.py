"""Jobs over the bank tables; every public function returns a lazy DataFrame."""
